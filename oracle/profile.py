"""Oracle SQL for the profiling reports (one SELECT per column, UNION ALL)."""

from hhlens.plans import specs
from hhlens.plans.registry import LINE_EXTRAS
from hhlens.sources.fixtures import LINEITEM_NUMERIC, PERSON_CODES, cte
from oracle.households import DOUBLE_FEATURES, HH_DOUBLE, JOINED, TRAIN_HH, full_cte

TRAIN_FULL_COLS = TRAIN_HH + JOINED
TRAIN_NUMERIC = [c for c in TRAIN_FULL_COLS if c != "id"]


def null_counts_sql() -> str:
    parts = [f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS n FROM hogares_full"
             for c in TRAIN_FULL_COLS]
    return full_cte("train") + "\nSELECT * FROM (\n" + "\nUNION ALL ".join(parts) + ") t WHERE n > 0"


def _iqr(prefix: str, table: str, cols) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS variable, (SELECT count(*) FILTER (WHERE {x} < b.q1 - 1.5 * (b.q3 - b.q1)"
            f" OR {x} > b.q3 + 1.5 * (b.q3 - b.q1)) FROM {table}) AS n_outliers FROM "
            f"(SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {table}) b")
    return prefix + "\nSELECT * FROM (\n" + "\nUNION ALL ".join(parts) + ") t"


def iqr_persons_sql() -> str:
    return _iqr(cte("personas") + ",\np AS (SELECT *, l_extendedprice / P6040 AS income_code FROM personas)", "p",
                [*PERSON_CODES, "income_code"])


def iqr_lineitem_sql() -> str:
    more = ", ".join(f"{e} AS {n}" for n, e in LINE_EXTRAS.items())
    return _iqr(f"WITH li AS (SELECT *, {more} FROM lineitem)", "li", [*LINEITEM_NUMERIC, *LINE_EXTRAS])


def iqr_households_sql() -> str:
    return _iqr(full_cte("train"), "hogares_full", TRAIN_NUMERIC)


def column_profile_sql(bins: int = 5) -> str:
    parts = []
    for c in PERSON_CODES:
        x = f"CAST({c} AS DOUBLE)"
        hist = ", ".join(
            f"(SELECT count(*) FILTER (WHERE {x} IS NOT NULL AND CASE WHEN r.hi = r.lo THEN ({i} = 0 AND {x} = r.lo) "
            f"ELSE least(floor(({x} - r.lo) / ((r.hi - r.lo) / {bins})), {bins - 1}) = {i} END) "
            f"FROM personas) AS h{i}" for i in range(bins))
        parts.append(f"""SELECT '{c}' AS variable, r.miss AS n_missing,
  round((r.n - r.miss) / r.n, 6) AS complete_rate, round(r.mean, 6) AS mean, round(r.sd, 6) AS sd,
  round(r.lo, 6) AS p0, round(r.hi, 6) AS p100, {hist},
  round(r.p25, 6) AS p25, round(r.p50, 6) AS p50, round(r.p75, 6) AS p75
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {c} IS NULL) AS miss, avg({x}) AS mean,
  stddev_samp({x}) AS sd, min({x}) AS lo, max({x}) AS hi, quantile_cont({x}, 0.25) AS p25,
  quantile_cont({x}, 0.5) AS p50, quantile_cont({x}, 0.75) AS p75 FROM personas) r""")
    return cte("personas") + "\nSELECT * FROM (\n" + "\nUNION ALL ".join(parts) + ") t"


def correlation_sql() -> str:
    cols = TRAIN_NUMERIC
    cc = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)
    where = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    corr_cols = []
    names = []
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            a, b = cols[i], cols[j]
            nm = f"c{i}_{j}"
            names.append((nm, a, b))
            corr_cols.append(f"CASE WHEN stddev_samp({a}) = 0 OR stddev_samp({b}) = 0 THEN NULL "
                             f"ELSE corr({a}, {b}) END AS {nm}")
    wide = f"wide AS (SELECT {', '.join(corr_cols)} FROM cc)"
    parts = [f"SELECT '{a}' AS var1, '{b}' AS var2, round({nm}, 6) AS r FROM wide" for nm, a, b in names]
    return (full_cte("train") + f",\ncc AS (SELECT {cc} FROM hogares_full WHERE {where}),\n{wide}\n"
            "SELECT * FROM (\n" + "\nUNION ALL ".join(parts) + ") t")


def quartiles_lineitem_sql() -> str:
    parts = [f"SELECT '{c}' AS variable, CAST({p} AS DOUBLE) AS p, "
             f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS q, count({c}) AS n FROM lineitem"
             for c in LINEITEM_NUMERIC for p in ("0.25", "0.5", "0.75")]
    return "SELECT * FROM (\n" + "\nUNION ALL ".join(parts) + ") t"


def fill_missing_sql() -> str:
    fill = ["TGP", "P_o", "JH_NoSeguro", "JH_RSS_Subsidiado", "JH_Trabaja", "JH_HorasExt",
            "JH_Independiente", "P5130", "tasa_desempleo"]
    sel = ", ".join(f"round({c}, 6) AS {c}" if (c in DOUBLE_FEATURES or c in HH_DOUBLE) else c for c in fill)
    return full_cte("train") + f"\nSELECT id, {sel} FROM hogares_full"


def factor_profile_sql(top: int = 4) -> str:
    parts = [f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS level, count(*) AS n FROM personas GROUP BY {c}"
             for c in specs.FACTOR_COLUMNS]
    return cte("personas") + ",\nlv AS (" + "\nUNION ALL ".join(parts) + f"""),
r AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, level) AS k FROM lv WHERE level IS NOT NULL),
t AS (SELECT variable, string_agg(level || ': ' || n, ', ' ORDER BY k) AS top_counts FROM r WHERE k <= {top} GROUP BY variable)
SELECT lv.variable, CAST(sum(CASE WHEN level IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_missing,
       round(1.0 - sum(CASE WHEN level IS NULL THEN n ELSE 0 END) / CAST(sum(n) AS DOUBLE), 6) AS complete_rate,
       count(level) AS n_unique, any_value(top_counts) AS top_counts
FROM lv LEFT JOIN t ON t.variable = lv.variable GROUP BY lv.variable"""


def factor_top_levels_sql(top: int = 5) -> str:
    cols = [*specs.FACTOR_COLUMNS, "P6800", "l_suppkey", "l_partkey", "id"]
    parts = [f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS level, count(*) AS n FROM personas "
             f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in cols]
    return cte("personas") + ",\nlv AS (" + "\nUNION ALL ".join(parts) + f""")
SELECT variable, CAST(rank AS INT) AS rank, level, n FROM (
  SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC, level) AS rank FROM lv) t WHERE rank <= {top}"""


def column_search_sql() -> str:
    named = [("P6100|P6920", c) for c in ("P6100", "P6920")] + [("^P75\\d\\d", c) for c in ("P7505", "P7510s3")]
    parts = [f"SELECT '{pattern}' AS pattern, '{c}' AS variable, count({c}) AS n_known, count(DISTINCT {c}) AS n_levels, "
             f"CAST(sum({c}) AS BIGINT) AS total FROM personas" for pattern, c in named]
    return cte("personas") + "\n" + "\nUNION ALL ".join(parts)


def reduce_joins_sql() -> str:
    # One pass of conditional aggregates instead of a join per table.
    return full_cte("test") + """,
per AS (SELECT id, count(*) AS n_persons, count(*) FILTER (WHERE P6920 = 1) AS pension,
  max(P6040) FILTER (WHERE P6040 < 18) AS oldest_minor, min(P6040) FILTER (WHERE P6100 IS NULL) AS youngest_uncovered
  FROM personas GROUP BY id)
SELECT h.id, h.Nper, per.n_persons, nullif(per.pension, 0) AS n_pension, per.oldest_minor, per.youngest_uncovered
FROM hogares_full h LEFT JOIN per ON per.id = h.id"""
