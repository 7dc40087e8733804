import hashlib
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from hhlens.llm import common, exact_dedup, simhash, suffix_dedup
from hhlens.llm.components import connected_components


# ---------------------------------------------------------------- exact dedup

def run_exact(df, tmp_path, **kw):
    return sorted(tuple(r) for r in exact_dedup.exact_dedup(
        df.sparkSession, str(tmp_path / "documents.parquet"), **kw).collect())


def test_exact_groups_nulls_and_ties(docs_df, tmp_path):
    df = docs_df([(1, "a"), (5, "a"), (3, "b"), (2, None), (4, ""), (5, "a"), (None, "b")])
    got = exact_dedup.exact_dedup(df.sparkSession, str(tmp_path / "documents.parquet"),
                                  files_per_batch=1).collect()
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    a, b, e = (by[hashlib.sha256(x).hexdigest()] for x in (b"a", b"b", b""))
    assert {r.keep_id for r in a} == {5} and {r.group_size for r in a} == {3}
    assert sum(r.kept for r in a) == 1 and all(r.doc_id == 5 for r in a if r.kept)
    assert {r.keep_id for r in b} == {3} and sum(r.kept for r in b) == 1
    assert {r.keep_id for r in e} == {4} and len(e) == 2


def test_exact_state_continues(spark, tmp_path):
    src, base = str(tmp_path / "d"), str(tmp_path / "base")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    frame([(1, "x"), (2, "y")]).write.parquet(src)
    assert exact_dedup.state_log(spark, src, base).count() == 2
    frame([(9, "x")]).write.mode("append").parquet(src)
    state = {r.n: r.keep.doc_id for r in exact_dedup.state_log(spark, src, base).collect()}
    assert state == {2: 9, 1: 2}


def test_exact_empty(docs_df, tmp_path):
    assert run_exact(docs_df([]), tmp_path) == []


def test_exact_collisions_are_split(docs_df, tmp_path, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_digest", lambda: F.substring("text", 1, 1))
    monkeypatch.setattr(exact_dedup, "HOT_GROUP", 1)
    df = docs_df([(1, "ab"), (2, "ab"), (3, "ac"), (4, "ac"), (5, "ac"), (6, "b")])
    got = {r[0]: r[1:4] for r in run_exact(df, tmp_path)}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (5, 3, False), 4: (5, 3, False),
                   5: (5, 3, True), 6: (6, 1, True)}


# ---------------------------------------------------------------- SimHash

def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_matches_definition():
    for t in (None, "", " \t\n", "One", "one two", "A b C", "x " * 500, "é Ü\x0b\x0c z ß 　 q",
              " ".join(str(i % 37) for i in range(1000))):
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(3)
    rng = random.Random(0)
    for _ in range(20_000):
        diff = sum({1 << rng.randrange(64) for _ in range(rng.randint(1, 3))})
        assert any(not diff & m for m in masks)


@pytest.mark.parametrize("hot", [2, 2000])
def test_links_connect_like_brute_force(spark, hot):
    rng = random.Random(hot)
    fps = {0}
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r[0]: r[1] for r in connected_components(simhash.links(df, hot=hot)).collect()}
    label = {x: x for x in signed}
    changed = True
    while changed:
        changed = False
        for a, x in zip(fps, signed):
            for b, y in zip(fps, signed):
                if (a ^ b).bit_count() <= 3 and label[x] < label[y]:
                    label[y], changed = label[x], True
    assert {x: got.get(x, x) for x in signed} == label


def test_components_of_a_path_a_hub_and_nothing(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = dict(tuple(r) for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_and_the_stage(docs_df):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(4, text), (2, text + " extra"), (9, text.upper()), (7, "something else entirely here"),
            (1, None), (3, "  "), (None, text), (None, "lonely words without any id")]
    df = docs_df(rows)
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(4, 2), (2, 2), (9, 2), (7, 7), (1, 1), (3, 1), (None, 2),
                                           (None, None)], key=str)
    kept = simhash.drop_near_duplicates(df.withColumn("_fp", F.lit(1)).withColumn("component_id", F.lit(2)))
    assert kept.columns == [*df.columns, "_fp", "component_id"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 7, None], key=str)
    assert simhash.near_duplicates(docs_df([], "none")).count() == 0


def test_the_stage_keeps_one_row_of_each_group_when_ids_repeat(docs_df):
    text, other = " ".join(f"w{i}" for i in range(400)), " ".join(f"x{i}" for i in range(300))
    rows = [(3, text), (5, text + " more"), (5, other), (5, other), (6, other), (None, other)]
    kept = simhash.drop_near_duplicates(docs_df(rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(3, text), (5, other)]
    assert simhash.drop_near_duplicates(docs_df([], "none")).count() == 0


# ---------------------------------------------------------------- suffix arrays

def brute(texts, length):
    seen = Counter()
    bodies = [(t or "").encode() for t in texts]
    for b in bodies:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] += 1
    out = []
    for b in bodies:
        gone = set()
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone.update(range(i, i + length))
        spans = sum(1 for i in gone if i - 1 not in gone)
        kept = bytes(x for i, x in enumerate(b) if i not in gone)
        out.append((len(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def run_suffix(df, texts, length, gram):
    cut = {bytes(r.tid): r for r in suffix_dedup.remove_repeats(df, length=length, gram=gram).collect()}
    out = []
    for t in texts:
        b = (t or "").encode()
        r = cut.get(hashlib.sha256(b).digest()[:16])
        out.append((r.n_removed, len(r.spans), r.kept_sha256) if r else (0, 0, hashlib.sha256(b).hexdigest()))
        if r:
            assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    return out


@pytest.mark.parametrize("hot, size", [(1, 2 << 20), (20_000, 2 << 20), (20_000, 120)])
def test_suffix_removal_equals_brute_force(docs_df, monkeypatch, hot, size):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", size)
    monkeypatch.setattr(suffix_dedup, "SPLITS", (5, 1))
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé\x00") for _ in range(rng.randint(1, 6)))
    shared = [" ".join(word() for _ in range(n)) for n in (4, 8, 20, 40)]
    texts = [None, "", "short", "a" * 90, "a" * 41, "ab" * 60]
    for _ in range(25):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        texts.append(rng.choice(shared).join(parts))
    texts += [texts[8], texts[8], texts[9]]
    df = docs_df([(i, t) for i, t in enumerate(texts)])
    assert run_suffix(df, texts, 40, 12) == brute(texts, 40)


def test_suffix_long_texts_are_cut_into_overlapping_chunks(docs_df, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 300)
    rng = random.Random(5)
    a = "".join(rng.choice("abcdefgh") for _ in range(2000))
    texts = [a, "zz" + a[250:900] + "yy", a[1990:] * 20]
    assert run_suffix(docs_df(list(enumerate(texts))), texts, 40, 12) == brute(texts, 40)


def test_suffix_empty(docs_df):
    assert suffix_dedup.remove_repeats(docs_df([])).count() == 0


def test_suffix_order_is_the_true_order():
    rng = random.Random(7)
    for alphabet in (b"a", b"ab", b"abcd", bytes(range(256))):
        for _ in range(30):
            t = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 80)))
            got = suffix_dedup.suffix_order(t, np.arange(len(t)), len(t) + 1)
            assert got.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
            lcp = suffix_dedup.common_prefixes(t, got, 40)
            for k in range(1, len(t)):
                x, y = t[got[k - 1]:], t[got[k]:]
                n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
                assert min(lcp[k], len(x), len(y)) == min(n, 40)


class Task:
    """Stands for a table whose function is called here."""

    def mapInArrow(self, run, schema):
        return run


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_suffix_runs_hold_a_small_part_of_the_text():
    rng = np.random.default_rng(9)
    texts = [rng.integers(97, 123, n, np.uint8).tobytes() for n in [2000] * 1500 + [1_500_000, 300]]
    batch = pa.RecordBatch.from_arrays([pa.array([b"%16d" % i for i in range(len(texts))], pa.binary()),
                                        pa.array(texts, pa.binary())], names=["tid", "body"])
    run = suffix_dedup.runs(Task())
    windows, mb = peak_mb(lambda: sum(sum(b.column(4).to_pylist()) for b in run(iter([batch]))))
    assert windows == sum(max(0, len(t) - 399) for t in texts)
    assert mb < 60


def test_suffix_block_of_runs_seen_twice_stays_small():
    rng = np.random.default_rng(10)
    strings = [(rng.integers(97, 101, 660, np.uint8).tobytes(), 261, True) for _ in range(400)]
    part = strings[7][0][:500]
    strings += [(part, 101, False), (bytes(660), 261, False)]
    hits, mb = peak_mb(lambda: suffix_dedup.repeated_windows(strings, 400))
    assert all(h.all() for h in hits[:-1])  # part lies in a run that is seen twice
    assert hits[-1].tolist() == [True] * 261  # equal windows inside one run
    assert mb < 45


def test_suffix_batches_are_bounded_by_bytes(spark, docs_df, monkeypatch):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own, seen, real = spark.conf.get(name), [], suffix_dedup.runs
    monkeypatch.setattr(suffix_dedup, "runs", lambda *a: seen.append(spark.conf.get(name)) or real(*a))
    texts = ["".join(random.Random(i % 3).choices("abcd", k=500)) for i in range(4)]
    assert run_suffix(docs_df(list(enumerate(texts))), texts, 40, 12) == brute(texts, 40)
    assert seen == [str(suffix_dedup.BATCH)] and spark.conf.get(name) == own

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["n"])

    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 1000) AS body")
    with common.arrow_batches(spark, 1 << 18):
        small = rows.mapInArrow(sizes, "n long").collect()
    assert sum(r.n for r in small) == 3000 and max(r.n for r in small) < 400
