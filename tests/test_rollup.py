"""Household rollup: the NULL rules and member cases of FIXTURES.md section 3."""

from conftest import households_df, persons_df

from hhlens.plans import households as hh
from hhlens.plans import specs
from hhlens.sources.fixtures import HEAD_ORDER


def _full(spark, persons, ids, split=True):
    return {r["id"]: r.asDict() for r in
            hh.household_table(persons_df(spark, persons), households_df(spark, ids),
                               member_order=HEAD_ORDER, split_member=split).collect()}


def test_household_without_persons(spark):
    out = _full(spark, [{"id": 1, "P6050": 1}], [1, 2])
    r = out[2]
    assert r["num_personas"] is None and r["JH_Edad"] is None and r["Hijos"] is None
    for c in specs.FILL_ZERO:
        assert r[c] == 0, c


def test_persons_without_head(spark):
    out = _full(spark, [{"id": 1, "P6050": 2, "P6040": 30}, {"id": 1, "P6050": 3, "P6040": 10}], [1])
    r = out[1]
    assert r["num_personas"] == 2 and r["Adultos"] == 1 and r["Hijos"] == 1
    assert r["trabajando"] is None and r["JH_Edad"] is None and r["JH_RSS_S"] is None
    assert r["JH_Microempresa"] is None          # in-set sums stay NULL without a head
    assert r["JH_NoSeguro"] == 0                 # filled after the merge


def test_two_heads_one_row(spark):
    rows = [{"id": 1, "P6050": 1, "P6040": 40, "P6090": 2, "l_partkey": 5},
            {"id": 1, "P6050": 1, "P6040": 60, "P6090": 1, "l_partkey": 3}]
    for split in (True, False):
        out = _full(spark, rows, [1], split)
        assert len(out) == 1
        r = out[1]
        assert r["JH_Edad"] == 50.0                       # mean over both heads
        assert r["JH_NoSeguro"] == 0.0                    # value of the first head by order (partkey 3)
        assert r["trabajando"] == 0


def test_all_codes_null_head(spark):
    r = _full(spark, [{"id": 1, "P6050": 1}], [1])[1]
    assert r["JH_BasicaSecundaria"] == 0.0 and r["JH_Microempresa"] == 0.0   # in-set -> 0
    assert r["JH_Media"] is None                                           # equality -> NULL
    assert r["JH_NoSeguro"] == 0.0 and r["JH_Trabaja"] == 0.0              # filled
    assert r["JH_HorasExt"] == 0.0 and r["JH_Horas_Trabajo"] == 0.0        # guards
    assert r["JH_Segundo_Trabajo"] == 0.0 and r["JH_Personas_Trabajo"] == 0.0
    assert r["JH_RSS_S"] == 0.0 and r["JH_Oc"] == 0.0


def test_hours_guard(spark):
    r = _full(spark, [{"id": 1, "P6050": 1, "P6870": 3}], [1])[1]
    assert r["JH_Personas_Trabajo"] is None
    assert r["JH_HorasExt"] == 0.0


def test_unemployment_rate_zero_over_zero(spark):
    r = _full(spark, [{"id": 1, "P6050": 1, "Oc": None, "Des": None, "Pet": None}], [1])[1]
    assert r["tasa_desempleo"] == 0.0 and r["TGP"] == 0.0 and r["P_o"] == 0.0


def test_any_nonzero_code(spark):
    r = _full(spark, [{"id": 1, "P6050": 1, "P7495": 2}], [1])[1]
    assert r["Ingresos_AlquilerPensiones"] == 1
    assert r["OtrosIngresos"] == 0


def test_ratios_and_sums(spark):
    rows = [{"id": 1, "P6050": 1, "Pet": 1, "Oc": 1, "P6585s1": 2},
            {"id": 1, "P6050": 2, "Pet": 1, "Des": 1, "P6585s1": 1},
            {"id": 1, "P6050": 3, "Pet": 1, "Ina": 1}]
    r = _full(spark, rows, [1])[1]
    assert abs(r["TGP"] - 1 / 3) < 1e-12 and abs(r["P_o"] - 1 / 3) < 1e-12
    assert r["tasa_desempleo"] == 0.5 and r["Subsidios"] == 3


def test_split_and_single_aggregate_agree(spark):
    from hhlens.sources import fixtures as fx
    from conftest import SF001

    p, h = fx.personas(spark, SF001), fx.hogares(spark, SF001)
    a = hh.household_table(p, h, member_order=fx.HEAD_ORDER, split_member=True)
    b = hh.household_table(p, h, member_order=fx.HEAD_ORDER, split_member=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dummies_share_train_levels(spark):
    from hhlens.functions.recode import add_dummies, dummy_levels

    train = spark.createDataFrame([(1,), (2,), (3,), (None,)], "P6100 int")
    test = spark.createDataFrame([(1,), (2,), (None,)], "P6100 int")
    lv = dummy_levels(train, ["P6100"])
    assert lv == {"P6100": [1, 2, 3]}
    out = add_dummies(test, lv).collect()
    assert [r["P6100_3"] for r in out] == [0.0, 0.0, None]
