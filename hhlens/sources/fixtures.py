"""Adapter views: the survey schemas (personas, hogares) over the TPC-H-like test tables.

The SQL text is shared by Spark and the DuckDB oracle, so both engines see the same rows.
Placeholders ``{lineitem}``, ``{orders}``, ``{customer}`` are filled with DataFrames on the
Spark side (``spark.sql(text, lineitem=df)``) and with plain table names for DuckDB.

Mapping (fixed values of the fixture definition):
  persons    <- lineitem, household key l_orderkey, head order (l_partkey, l_suppkey,
                l_extendedprice); w = l_quantity >= 6 (working age); m = (l_partkey+l_suppkey) % 6
  households <- orders join customer; train side o_orderkey % 5 <> 0, test side the rest
  label      Pobre = per-capita income below the line
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Column definitions of the persons view.
PERSONAS_SQL = """
SELECT id, l_partkey, l_suppkey, l_extendedprice,
  CAST(l_linenumber AS INT) AS P6050,
  CAST(1 + l_suppkey % 2 AS INT) AS P6020,
  CAST(CAST(l_quantity AS INT) * 2 AS INT) AS P6040,
  CAST(CASE l_suppkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 9 WHEN 2 THEN NULL ELSE 1 END AS INT) AS P6090,
  CAST(CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 1
            WHEN l_returnflag = 'N' THEN 2 ELSE 3 END AS INT) AS P6100,
  CAST(CASE WHEN l_quantity < 2 THEN NULL ELSE 1 + l_partkey % 6 END AS INT) AS P6210,
  CAST(CASE WHEN w THEN 1 + l_suppkey % 6 END AS INT) AS P6240,
  CAST(CASE WHEN w THEN 1 END AS INT) AS Pet,
  CAST(CASE WHEN w AND m <= 2 THEN 1 END AS INT) AS Oc,
  CAST(CASE WHEN w AND m = 3 THEN 1 END AS INT) AS Des,
  CAST(CASE WHEN w AND m >= 4 THEN 1 END AS INT) AS Ina,
  CAST(CASE WHEN w AND m <= 2 AND l_partkey % 17 <> 0 THEN CAST(l_quantity AS INT) + 10 END AS INT) AS P6800,
  CAST(CASE WHEN w AND m <= 2 THEN 1 + l_partkey % 9 END AS INT) AS P6870,
  CAST(CASE WHEN l_partkey % 3 = 0 THEN 1 + l_suppkey % 2 END AS INT) AS P6585s1,
  CAST(CASE WHEN w AND m <= 2 THEN 1 + l_suppkey % 9 END AS INT) AS P6430,
  CAST(CASE WHEN w AND m <= 2 THEN 1 + l_partkey % 3 END AS INT) AS P6920,
  CAST(CASE WHEN w AND m <= 2 THEN 1 + (l_partkey + 0) % 2 END AS INT) AS P6590,
  CAST(CASE WHEN w AND m <= 2 THEN 1 + (l_partkey + 1) % 2 END AS INT) AS P6600,
  CAST(CASE WHEN w AND m <= 2 THEN 1 + (l_partkey + 2) % 2 END AS INT) AS P7040,
  CAST(CASE WHEN w AND l_partkey % 4 = 0 THEN 1 + l_suppkey % 2 END AS INT) AS P7495,
  CAST(CASE WHEN w AND l_partkey % 5 = 0 THEN 1 + l_suppkey % 2 END AS INT) AS P7505,
  CAST(CASE WHEN w AND l_partkey % 7 = 0 THEN 1 + l_suppkey % 2 END AS INT) AS P7510s3
FROM (
  SELECT l_orderkey AS id, l_partkey, l_suppkey, l_extendedprice, l_linenumber, l_quantity,
         l_returnflag, l_quantity >= 6 AS w, (l_partkey + l_suppkey) % 6 AS m
  FROM {lineitem}
) t
"""

# Column definitions of the households view (label and income on train only).
_HOGARES_BASE = """
SELECT id, Depto, Nper, {label_cols}Lp, P5000, P5010, P5090, P5100, P5130, P5140
FROM (
  SELECT o_orderkey AS id,
    CAST(c_nationkey AS INT) AS Depto,
    CAST(1 + o_orderkey % 8 AS INT) AS Nper,
    CAST(o_totalprice AS DOUBLE) AS Ingtotug,
    CAST(o_totalprice / (1 + o_orderkey % 8) AS DOUBLE) AS Ingpcug,
    CAST(21000 + 100 * c_nationkey AS DOUBLE) AS Lp,
    CAST(CASE WHEN o_totalprice / (1 + o_orderkey % 8) < 21000 + 100 * c_nationkey THEN 1 ELSE 0 END AS INT) AS Pobre,
    CAST(1 + o_orderkey % 7 AS INT) AS P5000,
    CAST(1 + o_orderkey % 4 AS INT) AS P5010,
    CAST(1 + o_custkey % 6 AS INT) AS P5090,
    CAST(CASE WHEN o_custkey % 6 = 1 THEN o_orderkey % 900 END AS DOUBLE) AS P5100,
    CAST(CASE WHEN o_custkey % 6 <> 2 THEN o_orderkey % 1000 END AS DOUBLE) AS P5130,
    CAST(CASE WHEN o_custkey % 6 = 2 THEN o_orderkey % 700 END AS DOUBLE) AS P5140
  FROM {orders} JOIN {customer} ON o_custkey = c_custkey
  WHERE {side}
) t
"""

HOGARES_TRAIN_SQL = _HOGARES_BASE.replace("{label_cols}", "Pobre, Ingtotug, Ingpcug, ").replace(
    "{side}", "o_orderkey % 5 <> 0")
HOGARES_TEST_SQL = _HOGARES_BASE.replace("{label_cols}", "").replace(
    "{side}", "o_orderkey % 5 = 0")

VIEW_SQL = {
    "personas": PERSONAS_SQL,
    "hogares_train": HOGARES_TRAIN_SQL,
    "hogares_test": HOGARES_TEST_SQL,
}

# Head-of-household order used by the fixtures (ties broken by these columns).
HEAD_ORDER = ("l_partkey", "l_suppkey", "l_extendedprice")


def duckdb_sql(view: str) -> str:
    """The view text with bare table names, for the DuckDB oracle."""
    return (VIEW_SQL[view].replace("{lineitem}", "lineitem").replace("{orders}", "orders")
            .replace("{customer}", "customer"))


def cte(*views: str) -> str:
    """``WITH name AS (...), ...`` prefix of the requested views for oracle SQL."""
    return "WITH " + ",\n".join(f"{v} AS ({duckdb_sql(v)})" for v in views)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def personas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PERSONAS_SQL, lineitem=table(spark, sf_dir, "lineitem"))


def hogares(spark: SparkSession, sf_dir: str, side: str = "train") -> DataFrame:
    text = HOGARES_TRAIN_SQL if side == "train" else HOGARES_TEST_SQL
    return spark.sql(text, orders=table(spark, sf_dir, "orders"),
                     customer=table(spark, sf_dir, "customer"))

# Survey code columns of the persons view (the head-order columns are not survey data).
PERSON_CODES = ("P6050", "P6020", "P6040", "P6090", "P6100", "P6210", "P6240", "Pet", "Oc", "Des",
                "Ina", "P6800", "P6870", "P6585s1", "P6430", "P6920", "P6590", "P6600", "P7040",
                "P7495", "P7505", "P7510s3")
LINEITEM_NUMERIC = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax")
