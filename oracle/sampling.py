"""Oracle SQL for SMOTE and exact kNN: brute-force pairs (fine at the check scale)."""

from hhlens.plans import specs
from oracle.models import _input

X = specs.FOREST_FINAL_PREDICTORS


def _h(expr: str, seed: str) -> str:
    return f"('0x' || substr(md5(concat(CAST({expr} AS VARCHAR), '|', '{seed}')), 1, 8))::BIGINT"


def _base() -> str:
    cols = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in X)
    d2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in X)
    return _input() + f""",
mino AS (SELECT id, Pobre, {cols} FROM mi WHERE Pobre = 1),
pairs AS (SELECT a.id, b.id AS nn_key, {d2} AS d2 FROM mino a JOIN mino b ON a.id <> b.id),
nn AS (SELECT * FROM (SELECT id, nn_key, row_number() OVER (PARTITION BY id ORDER BY d2, nn_key) AS nn_rank
                      FROM pairs) t WHERE nn_rank <= 5)"""


def knn_minority() -> str:
    return _base() + "\nSELECT id, nn_key, CAST(nn_rank AS INT) AS nn_rank FROM nn"


def smote_exact() -> str:
    feats = ", ".join(f"round(b.{c} + j.u * (n.{c} - b.{c}), 6) AS {c}" for c in X)
    return _base() + f""",
cnt AS (SELECT count(*) FILTER (WHERE Pobre = 1) AS n_min, count(*) FILTER (WHERE Pobre <> 1) AS n_maj FROM mi),
ranked AS (SELECT *, row_number() OVER (ORDER BY h, id) AS rk FROM (SELECT *, {_h('id', '123')} AS h FROM mino) t),
jobs AS (SELECT r.range AS j, (r.range - 1) % cnt.n_min + 1 AS rk,
                CAST({_h('r.range', '123|nn')} % 5 + 1 AS INT) AS nn_rank,
                CAST({_h('r.range', '123|u')} AS DOUBLE) / 4294967296.0 AS u
         FROM cnt, range(1, (SELECT ceil(1.0 * n_maj) - n_min + 1 FROM cnt)::BIGINT) r)
SELECT -j.j AS id, 1 AS Pobre, {feats}
FROM jobs j JOIN ranked b ON b.rk = j.rk JOIN nn ON nn.id = b.id AND nn.nn_rank = j.nn_rank
JOIN mino n ON n.id = nn.nn_key"""
