"""Oracle SQL for the descriptive tables."""

from hhlens.plans import specs
from oracle.households import full_cte

POVERTY_BY_DEPARTMENT = full_cte("train") + """,
counts AS (SELECT Depto, Pobre, count(*) AS Conteo FROM hogares_full GROUP BY Depto, Pobre),
shares AS (SELECT Depto, Pobre, Conteo, Conteo * 100.0 / sum(Conteo) OVER (PARTITION BY Depto) AS Prop FROM counts),
ranks AS (SELECT Depto, row_number() OVER (ORDER BY Prop DESC, Depto ASC) AS ord FROM shares WHERE Pobre = 1)
SELECT s.Depto, s.Pobre, s.Conteo, round(s.Prop, 6) AS Prop, r.ord, n.n_name AS Nombre_Depto,
       regexp_replace(CAST(round(s.Prop, 1) AS VARCHAR), '\\.0$', '') || '%' AS Prop_label
FROM shares s LEFT JOIN ranks r USING (Depto) LEFT JOIN nation n ON n.n_nationkey = s.Depto
"""

CLASS_SHARE = full_cte("train") + """
SELECT Pobre, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct,
       CASE Pobre WHEN 0 THEN 'No Pobres' WHEN 1 THEN 'Pobres' END AS class_label
FROM hogares_full GROUP BY Pobre
"""

SHARE_BY_HEAD_SEX = full_cte("train") + """
SELECT Pobre, round(JH_Mujer, 6) AS JH_Mujer, count(*) AS n,
       round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY Pobre), 6) AS share,
       CASE JH_Mujer WHEN 0 THEN 'Hombre' WHEN 1 THEN 'Mujer' END AS sex_label,
       CASE Pobre WHEN 0 THEN 'No Pobres' WHEN 1 THEN 'Pobres' END AS class_label
FROM hogares_full GROUP BY Pobre, JH_Mujer
"""


def _fill(x: str) -> str:
    return full_cte("train") + f"""
SELECT {x}, Pobre, count(*) AS n,
       round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY {x}), 6) AS share
FROM hogares_full WHERE {x} BETWEEN 0 AND 10 GROUP BY {x}, Pobre
"""


SHARE_BY_CHILDREN = _fill("Hijos")
SHARE_BY_SIZE = _fill("Nper")

POVERTY_BY_LOOKUP = POVERTY_BY_DEPARTMENT.replace("n.n_name AS Nombre_Depto", "n.name AS Nombre_Depto").replace(
    "nation n ON n.n_nationkey = s.Depto",
    "(VALUES " + ", ".join(f"({k}, '{v}')" for k, v in specs.DEPARTAMENTOS) + ") n(code, name) ON n.code = s.Depto")
