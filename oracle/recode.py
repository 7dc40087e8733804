"""Oracle SQL for dummies and kernel densities."""

from hhlens.sources.fixtures import cte


def _d(c, v):
    return f"CASE WHEN {c} = {v} THEN 1.0 WHEN {c} IS NOT NULL THEN 0.0 END AS {c}_{v}"


DUMMIES = cte("personas") + "\nSELECT id, P6100, P6920, " + ", ".join(
    _d(c, v) for c in ("P6100", "P6920") for v in (1, 2, 3)) + " FROM personas"


def density_sql(x: str, where: str, group: str | None = None, log10: bool = False) -> str:
    g = group or "0"
    xe = f"log10(CAST({x} AS DOUBLE))" if log10 else f"CAST({x} AS DOUBLE)"
    pos = f" AND {x} > 0" if log10 else ""
    gsel = f"{group}, " if group else ""
    return cte("hogares_train") + f""",
src AS (SELECT {g} AS g, {xe} AS x FROM hogares_train WHERE {where} AND {x} IS NOT NULL{pos}),
rng AS (SELECT min(x) AS lo_all, max(x) AS hi_all FROM src),
st AS (SELECT g, count(*) AS n, stddev_samp(x) AS sd, quantile_cont(x, 0.25) AS q1,
              quantile_cont(x, 0.75) AS q3 FROM src GROUP BY g),
bw AS (SELECT g, n, 0.9 * (CASE WHEN least(sd, (q3 - q1) / 1.34) > 0 THEN least(sd, (q3 - q1) / 1.34)
                                 WHEN sd > 0 THEN sd ELSE 1.0 END) * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM st),
par AS (SELECT g, n, bw, lo_all - 4.0 * bw AS lo,
               ((hi_all + 4.0 * bw) - (lo_all - 4.0 * bw)) / 511.0 AS delta, lo_all, hi_all FROM bw, rng),
b AS (SELECT s.g, floor((x - lo) / delta) AS ix, (x - lo) / delta - floor((x - lo) / delta) AS fx
      FROM src s JOIN par p ON s.g = p.g),
m AS (SELECT g, j, sum(w) AS mass FROM (SELECT g, ix AS j, 1.0 - fx AS w FROM b
                                       UNION ALL SELECT g, ix + 1 AS j, fx AS w FROM b) u GROUP BY g, j),
grid AS (SELECT range AS i FROM range(512)),
t AS (SELECT m.g AS g, i, lo_all + i * ((hi_all - lo_all) / 511.0) AS gx,
             (mass / CAST(n AS DOUBLE)) * exp(-0.5 * ((lo_all + i * ((hi_all - lo_all) / 511.0) - (lo + j * delta)) / bw)
               * ((lo_all + i * ((hi_all - lo_all) / 511.0) - (lo + j * delta)) / bw)) / (bw * 2.5066282746310002) AS term
      FROM m JOIN par p ON m.g = p.g, grid)
SELECT {('g AS ' + group + ', ') if group else ''}CAST(i AS INT) AS i, round(gx, 6) AS x, round(sum(term), 12) AS density
FROM t GROUP BY g, i, gx"""


INCOME_DENSITY = density_sql("Ingpcug", "Pobre = 0")
INCOME_DENSITY_TOTAL_POOR = density_sql("Ingtotug", "Pobre = 1")
INCOME_DENSITY_LOG10 = density_sql("Ingpcug", "Pobre = 0", log10=True)
INCOME_DENSITY_LOG10_BY_CLASS = density_sql("Ingpcug", "Pobre IN (0, 1)", group="Pobre", log10=True)

CSV_SCAN = cte("hogares_test") + """
SELECT id, Depto, Nper, round(Lp, 6) AS Lp, P5000, P5010, P5090, round(P5100, 6) AS P5100,
       round(P5130, 6) AS P5130, round(P5140, 6) AS P5140 FROM hogares_test"""
