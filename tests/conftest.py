import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hhlens.session import build_session

    s = build_session("local[4]", app="hhlens-tests", shuffle_partitions=4,
                      spark__driver__memory="8g")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hhlens-test-ckpt-"))
    yield s
    s.stop()


PERSON_COLS = ["id", "l_partkey", "l_suppkey", "l_extendedprice", "P6050", "P6020", "P6040",
               "P6090", "P6100", "P6210", "P6240", "Pet", "Oc", "Des", "Ina", "P6800", "P6870",
               "P6585s1", "P6430", "P6920", "P6590", "P6600", "P7040", "P7495", "P7505",
               "P7510s3"]


def persons_df(spark, rows):
    """rows: dicts with any subset of PERSON_CODES; missing codes are NULL."""
    schema = ("id bigint, l_partkey bigint, l_suppkey bigint, l_extendedprice double, " +
              ", ".join(f"{c} int" for c in PERSON_COLS[4:]))
    data = []
    for i, r in enumerate(rows):
        base = {"l_partkey": i, "l_suppkey": 0, "l_extendedprice": 0.0}
        base.update(r)
        data.append(tuple(base.get(c) for c in PERSON_COLS))
    return spark.createDataFrame(data, schema)


def households_df(spark, ids):
    rows = [(i, 1, 2, 0, 1.0, 1.0, 21000.0, 1, 1, 1, None, None, None) for i in ids]
    return spark.createDataFrame(rows, "id bigint, Depto int, Nper int, Pobre int, Ingtotug double, "
                                       "Ingpcug double, Lp double, P5000 int, P5010 int, P5090 int, "
                                       "P5100 double, P5130 double, P5140 double")
