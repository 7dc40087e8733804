import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from hhlens.llm import chat_repair as R
from hhlens.llm import licenses as L
from hhlens.llm import queries as Q
from hhlens.llm import whitening as W

CHAT = "conv_id long, turn long, role string, text string, cls string, c long"
SF001 = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- conversation repair

def exhaustive(word):
    """Cheapest (cost, audit) over every choice of edits with up to two inserts at each gap."""
    best = None
    for ops in itertools.product(*[("D",) if s == "D" else "DKR" for s in word]):
        for gaps in itertools.product(range(3), repeat=len(word) + 1):
            cost, audit, said = 0, "", ""
            for s, op, g in zip(word, ops, gaps):
                audit += "I" * g + op
                said += "?" * g + {"D": "", "R": "?", "K": s.lower()}[op]
                cost += 3 * g + {"D": 4, "R": 3, "K": 0}[op] + (3 if op != "D" and s.isupper() else 0)
            audit, said, cost = audit + "I" * gaps[-1], said + "?" * gaps[-1], cost + 3 * gaps[-1]
            body = said[1:] if said[:1] == "s" else said
            if said == "s" or len(body) % 2 or any(c not in (want, "?") for c, want in zip(body, "ua" * len(body))):
                continue
            best = min(best or (cost, audit), (cost, audit))
    return best


@pytest.mark.parametrize("seed", range(3))
def test_the_matrices_find_the_cheapest_edits(seed):
    rng = random.Random(seed)
    for n in range(1, 5):
        for _ in range(12 if n < 4 else 3):
            word = "".join(rng.choice("DsuaoSUAO") for _ in range(n))
            assert R.cheapest(R.word_matrix(word)) == exhaustive(word), word


def plain(word):
    """The same by one state at a time, with plain strings."""
    row = {0: (0, "")}
    ins = {0: {0: "", 2: "I", 3: "II"}, 1: {1: "", 2: "I", 3: "II"}, 2: {2: "", 3: "I"}, 3: {3: "", 2: "I"}}
    for s in word:
        new = {}
        for x, (cost, audit) in row.items():
            for y, text in ins[x].items():
                more = 3 if s.isupper() and s != "D" else 0
                to = [(y, 4, "D")]
                if s != "D":
                    to.append((2 if y != 2 else 3, 3 + more, "R"))
                    keep = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(s.lower(), {})
                    if y in keep:
                        to.append((keep[y], more, "K"))
                for z, c, op in to:
                    new[z] = min(new.get(z, (10**9, "")), (cost + 3 * len(text) + c, audit + text + op))
        row = new
    return min((c + 3 * len(t), a + t) for x, (c, a) in row.items() for y, t in ins[x].items() if y in (0, 3))


def test_grammar_never_changes_a_result(spark):
    rng = random.Random(7)
    words = ["".join(rng.choices("usaDUAoS", [30, 5, 30, 5, 3, 3, 2, 1], k=rng.randint(1, 60))) for _ in range(200)]
    words += ["ua" * 300, "u" * 257, "D" * 100]
    grammar = R.learn_grammar(spark.createDataFrame([(w,) for w in words], "word string").repartition(3))
    assert grammar and grammar[0] in ("ua", "au")
    for w in words:
        assert len(R.compress(w, grammar)) <= len(w)
        assert R.cheapest(R.word_matrix(w, grammar)) == R.cheapest(R.word_matrix(w)) == plain(w)


def test_ropes_compare_like_strings():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice(["", "K", "DI", "KK", "R"]) for _ in range(rng.randint(0, 8))]
        b = a[:rng.randint(0, len(a))] + [rng.choice(["", "K", "I"]) for _ in range(3)]
        ropes = [sum((R.Rope(x) for x in p), R.Rope()) for p in (a, b)]
        assert [str(r) for r in ropes] == ["".join(a), "".join(b)]
        assert (ropes[0] < ropes[1]) == ("".join(a) < "".join(b))


def duck(path, sql=None):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet/*.parquet'")
    rel = con.sql(sql or Q.OP11_SQL)
    return sorted((dict(zip(rel.columns, r)) for r in rel.fetchall()), key=str)


def as_dicts(df, columns):
    return sorted(({c: r[c] for c in columns} for r in df.collect()), key=str)


def odd_chats():
    rng = random.Random(3)
    text = ["Hello there.", "What is it?", "cut of", "", "  \t", None, "Long!" * 2000, "a. b. c"]
    role = ["user", "assistant", "system", "tool", "", None, "u", "agent"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choices(role, [9, 9, 3, 1, 1, 1, 1, 1])[0], rng.choice(text))
            for c in [None, *range(40)] for _ in range(rng.randint(1, 12))]
    rows += rows[:30]                                            # repeated rows
    rows += [(77, t, "user" if t % 2 else "assistant", f"turn {t % 50}.") for t in range(400)]    # a third of all rows
    return [(*r, "clash", 5) for r in rows]


def test_op11_equals_its_sql_on_odd_rows_and_a_hot_conversation(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame(odd_chats(), CHAT).repartition(5).write.parquet(f"{path}/conversations.parquet")
    want = duck(path)
    got = as_dicts(Q.op11_conversation_repair(spark, path), want[0])
    assert got == want and len(want) == 42


def test_op11_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], CHAT).write.parquet(f"{tmp_path}/conversations.parquet")
    assert Q.op11_conversation_repair(spark, str(tmp_path)).collect() == []


def test_repaired_turns_follow_the_grammar_and_the_digest(spark):
    turns = spark.createDataFrame([r[:4] for r in odd_chats()], "conv_id long, turn long, role string, text string")
    said = {}
    for r in R.repaired_turns(turns).orderBy("conv_id", "turn").collect():
        said.setdefault(r.conv_id, []).append(r)
    for r in R.repair(turns).collect():
        rows = said.get(r.conv_id, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(x.role[0] for x in rows))
        assert [x.turn for x in rows] == list(range(len(rows)))
        assert "".join(x.edit for x in rows) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in rows).encode()).hexdigest() == r.repaired_sha256
    none = R.repair(turns.where("false"), turns.select("conv_id"))
    assert {(r.cost, r.audit, r.repaired_sha256) for r in none.collect()} == {(0, "", hashlib.sha256().hexdigest())}


# ---------------------------------------------------------------- license scan

def sample(parsed, rng):
    """A random string that the parsed expression matches."""
    out = ""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "NOT_LITERAL":
            out += "q"
        elif name == "IN":
            op2, arg2 = rng.choice(arg)
            out += {"LITERAL": lambda: chr(arg2), "NEGATE": lambda: "q", "CATEGORY": lambda: "7",
                    "RANGE": lambda: chr(arg2[0])}[str(op2)]()
        elif name == "BRANCH":
            out += sample(rng.choice(arg[1]), rng)
        elif name == "SUBPATTERN":
            out += sample(arg[3], rng)
        elif name == "MAX_REPEAT":
            low, high, body = arg
            out += "".join(sample(body, rng) for _ in range(rng.randint(low, min(high, low + 2))))
        else:
            raise AssertionError(name)
    return out


def test_there_are_hundreds_of_rules_and_each_match_has_its_word():
    rng = random.Random(0)
    assert len(L.rules()) > 300 and len({r.order for r in L.rules()}) == len(L.rules())
    for r in L.rules():
        for _ in range(25):
            line = sample(re._parser.parse(r.pattern), rng)
            assert set(r.word.split("|")) & set(line.split()), (r, line)


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
    ("SPDX-License-Identifier: MIT", ["mit"]),
    ("Released under the MIT license.", ["mit"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl", "gpl-3.0"]),
    ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", ["gpl", "lgpl"]),
    ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc-4.0"]),
    ("(c) 2020 Foo. All Rights Reserved.", ["reserved"]),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files", ["mit"]),
    ("This is free and unencumbered software released into the public domain.", ["unlicense"]),
    ("Todos los derechos reservados", ["reserved-es"]),
    ("We met the limits of summit and admitted it.", []),
    ("", []), (None, []),
])
def test_labels_of_known_lines(text, labels):
    got = L.scan_text(text)
    assert got["labels"] == labels and set(got["base_labels"]) <= set(labels)
    assert 0 <= got["score"] <= 1 and (got["score"] > 0) == bool(labels)


def slow_resolve(found):
    kept = []
    for m in sorted(found, key=lambda m: (-m.priority, -(m.end - m.start), m.start, m.order)):
        if not any((k.priority > m.priority and k.start < m.end and m.start < k.end)
                   or (k.priority == m.priority and k.start <= m.start and m.end <= k.end) for k in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: (m.start, m.end, m.order))


def test_resolution_equals_the_rules_one_by_one():
    rng = random.Random(5)
    for _ in range(300):
        found = []
        for i in range(rng.randint(0, 25)):
            a = rng.randint(0, 40)
            found.append(L.Match(f"l{i}", rng.randint(0, 3), a, a + rng.randint(1, 9), i))
        assert L.resolve(found) == slow_resolve(found)


def test_op12_whole_table_against_all_rules_without_prefilter(spark):
    rows = {r.doc_id: r for r in Q.op12_license_scan(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), d.text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
        starts = {p: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()] for p in L.BASE}
        every = sorted(x for v in starts.values() for x in v)
        base = sorted(L.BASE[p] for p, v in starts.items() if v)
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(every), every[0] if every else None, every[-1] if every else None, ",".join(base))
        line, found = " " + " ".join(words) + " ", []
        for rule in L.rules():
            for m in re.finditer(f"(?<= )(?:{rule.pattern})(?= )", line):
                found.append(L.Match(rule.label, rule.priority, line[:m.start()].count(" ") - 1,
                                     line[:m.end()].count(" "), rule.order))
        assert r.labels == ",".join(sorted({m.label for m in slow_resolve(found)} | set(base)))


def test_scan_odd_rows(spark):
    long = "mit license " * 30_000 + "all rights reserved"
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (None, long, "y"), (3, "© É cc-by\x00x", "z")],
                               "doc_id long, text string, labels string")
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word) for r in L.scan(df).collect()}
    assert got == {(1, 0, 0, None, None), (None, 60_003, 1, 60_000, 60_000), (3, 5, 1, 2, 2)}
    assert L.scan(df).count() == 4 and L.scan(df.where("false")).collect() == []


# ---------------------------------------------------------------- whitening

VEC = "vec_id long, embedding array<double>, n int, whitened string"


def exact(vectors):
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[(n * c - s) / n for c, s in zip(r, sums)] for r in x])
    dev = [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x]
    e, q = np.linalg.eigh(y.T @ y / n)
    return y, dev, e[::-1], q[:, ::-1]


def check_whole(df, vectors, ids, expect):
    y, dev, e, q = exact(vectors)
    model = W.fit(df)
    rows = {r.vec_id: r for r in W.transform(model).collect()}
    assert len(model.axes) == expect and len(rows) == len(ids)
    assert np.allclose(model.variances, e[:expect], rtol=1e-9) and abs(model.total / e.sum() - 1) < 1e-12
    assert model.identity_error < 1e-9
    got = np.array([rows[i].whitened for i in ids])
    assert [int(rows[i].deviation) for i in ids] == dev
    return y, e, q, got


def test_whitening_equals_a_dense_solver_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = df.collect()
    y, e, q, got = check_whole(df, [r.embedding for r in rows], [r.vec_id for r in rows], 8)
    want = y @ q[:, :8] / np.sqrt(e[:8])
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-9
    out = Q.op13_embedding_whitening(spark, SF001)
    assert out.count() == 8 * len(rows) and {r.component for r in out.select("component").distinct().collect()} == set(range(1, 9))
    assert out.where("deviation IS NULL OR identity_error > 1e-4").count() == 0


def test_low_rank_equal_variances_and_repeated_rows(spark):
    # Rank 5: four directions with the very same variance, each row twice, and constant columns.
    rows = [[s / 8 if j == i else 0.0 for j in range(4)] + [t / 2, 3.0, 3.0] for i in range(4) for s in (-1, 1) for t in (-1, 1)]
    vectors = rows + rows
    df = spark.createDataFrame([(i, v, 1, "") for i, v in enumerate(vectors)], VEC).repartition(3)
    y, e, q, got = check_whole(df, vectors, list(range(len(vectors))), 5)
    assert np.allclose(got.T @ got / len(got), np.eye(5), atol=1e-9)


def test_nearly_flat_spectrum_with_a_tiny_direction(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(-400, 400, (300, 12))
    x[:, 3] = x[:, 2] + rng.integers(0, 2, 300)
    vectors = (x / 1024).tolist()
    df = spark.createDataFrame([(i, v, 1, "") for i, v in enumerate(vectors)], VEC)
    y, e, q, got = check_whole(df, vectors, list(range(300)), 8)
    want = y @ q[:, :8] / np.sqrt(e[:8])
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-8


def test_an_early_end_leaves_nothing_out(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 3)) @ rng.standard_normal((3, 40)) * 50 + rng.standard_normal((200, 40)) * 0.02
    df = spark.createDataFrame([(i, v, 1, "") for i, v in enumerate(x.tolist())], VEC)
    model = W.fit(df, components=3)
    y, dev, e, q = exact(x.tolist())
    assert model.steps < 20 and np.allclose(model.variances, e[:3], rtol=1e-9)
    assert np.allclose(np.abs((model.axes @ q[:, :3]).diagonal()), 1, atol=1e-12)


def test_whitening_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    odd = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, inf]), (5, [nan, 1.0]), (6, [1.0, 2.0, 3.0]),
           (7, [1.0, 2.0]), (None, [0.5, -1.0]), (7, [1.0, 2.0]), (8, [1e300, 0.0])]
    df = spark.createDataFrame([(*r, 0, "") for r in odd], VEC)
    model = W.fit(df)
    assert model.blocks.n == 4 and sorted(str(r.vec_id) for r in W.transform(model).collect()) == ["7", "7", "8", "None"]
    one = df.where("vec_id = 7")
    assert W.transform(W.fit(one)).collect() == [] and W.transform(W.fit(df.where("false"))).collect() == []


def test_op13_has_no_rows_without_variance(spark, tmp_path):
    spark.createDataFrame([(1, [1.0, 2.0], 0, "")], VEC).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = Q.op13_embedding_whitening(spark, str(tmp_path))
    assert out.collect() == [] and "explained" in out.columns
