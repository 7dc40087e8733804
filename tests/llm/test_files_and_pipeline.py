import base64
import hashlib
import os
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hhlens.llm import decontamination, queries, simhash, token_output, warc
from hhlens.llm.decontamination import Index, allowed, words_of

PAGES = "page_id long, url string, html string, at string, digest string"
ROWS = [(1, "http://a.com/x y", "<p>é</p>"), (2, "https://b.a.com/?q=1", "<p>é</p>"), (9, None, None),
        (4, "http://a.com/x y", ""), (5, "weird\r\nWARC-Type: x", "WARC/1.0\r\n\r\n"), (None, "http://z.org", "z"),
        (6, "http://a.com/x y", "long " * 20_000), (7, "http://a.com/x y", "z"), (7, "http://a.com/x y", "z")]


def pages_of(spark, tmp_path, rows):
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("stored", [True, False])
def test_archives_round_trip(spark, tmp_path, stored):
    df = pages_of(spark, tmp_path, ROWS) if stored else spark.createDataFrame(
        [(*r, "x", "y") for r in ROWS], PAGES)
    archive, index, captures = warc.archive_pages(df, block_lines=2)
    got = Counter(tuple(r) for r in warc.read_back(captures, archive, index).collect())
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    want = Counter()
    for p, _, h in ROWS:
        h = h or ""
        top = max((q for q, _, x in ROWS if (x or "") == h and q is not None), default=None)
        first = p == top and (p, "done") not in want
        want[(p, len(h.encode()), sha(h), "response" if first else "revisit", None if first else top)] += 1
        if p == 7:  # the repeated page: one response, one revisit to it
            continue
    twice = (7, 1, sha("z"), "response", None)
    want[twice] = 1
    want[(7, 1, sha("z"), "revisit", 7)] = 1
    assert got == want


def test_lookup_by_key_and_prefix(spark, tmp_path):
    archive, index, captures = warc.archive_pages(pages_of(spark, tmp_path, ROWS), block_lines=2)
    keys = spark.createDataFrame([(warc.capture_key("http://a.com/x y", 6),), (warc.capture_key("http://q.com/", 1),)],
                                 "key string")
    got = warc.lookup(keys, archive, index).collect()
    assert [(r.page_id, bytes(r.payload)) for r in got] == [(6, ("long " * 20_000).encode())]
    under = captures.where(warc.prefix_range(F.col("key"), "http://a.com/"))
    assert sorted(r.page_id for r in under.collect()) == [1, 4, 6, 7, 7]
    assert warc.url_key("HTTP://B.a.com/P?q") == "com,a,b)/P?q"


def test_small_payloads_are_all_responses(spark, tmp_path):
    archive, index, captures = warc.archive_pages(pages_of(spark, tmp_path, ROWS), min_bytes=2)
    got = {(r.page_id, r.record_type) for r in warc.read_back(captures, archive, index).collect()}
    assert {(7, "response"), (9, "response"), (4, "response"), (1, "revisit"), (2, "response")} <= got


def test_no_pages(spark, tmp_path):
    archive, index, captures = warc.archive_pages(pages_of(spark, tmp_path, []))
    assert warc.read_back(captures, archive, index).count() == 0


# ---------------------------------------------------------------- token shards

@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000])
def test_permutation_is_a_bijection_with_an_inverse(n):
    keys = token_output.round_keys("k")
    slots = token_output.permute(np.arange(n), n, keys)
    assert sorted(slots.tolist()) == list(range(n))
    assert token_output.permute(slots, n, keys, inverse=True).tolist() == list(range(n))
    if n >= 256:
        assert slots.tolist() != token_output.permute(np.arange(n), n, token_output.round_keys("j")).tolist()
        assert np.abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def test_split_without_look_ahead_is_the_same():
    with open(token_output.TOKENIZER, "rb") as f:
        enc = token_output.Encoder(f.read())
    for t in ("", " ", "a  b", "a b ", "x\n\n y", "it's 12\t3", "　 é", "ab " * 50, "end\n"):
        assert enc(t) == enc.full(t)
    assert len(enc("a" * 50_000)) > 0 and len(enc(" " * 50_000)) > 0


def test_shards_hold_every_token_once_and_resume(docs_df):
    rows = [(i, f"text number {i} " * (i % 30)) for i in range(120)] + [(None, None), (5, "again"), (500, "")]
    df = docs_df(rows).withColumn("slot", F.lit(1))
    kw = dict(seq_len=64, shard_seqs=10)
    m = token_output.write_shards(df, **kw).cache()
    n = m.count()
    assert sorted(r.slot for r in m.collect()) == list(range(n))
    assert all(r.shard == r.slot // 10 and r.offset == r.slot % 10 * 128 for r in m.collect())
    seqs = {r.slot: r for r in token_output.read_shards(m, seq_len=64).collect()}
    with open(token_output.TOKENIZER, "rb") as f:
        enc = token_output.Encoder(f.read())
    want, got = Counter(), Counter()
    for _, t in rows:
        want.update([*enc(t or ""), token_output.EOS])
    for r in seqs.values():
        got.update(r.tokens[:r.n_tokens])
        assert r.tokens[r.n_tokens:] == [token_output.EOS] * (64 - r.n_tokens)
    assert got == want
    assert {d for r in seqs.values() for d in r.doc_ids} == {i for i, _ in rows}
    assert sorted(r.slot for r in token_output.read_shards(m, seq_len=64, start=7).collect()) == list(range(7, n))
    assert token_output.checked(m, seq_len=64).count() == n
    again = token_output.write_shards(df, **kw)
    assert {(r.slot, r.sha256) for r in again.collect()} == {(r.slot, r.sha256) for r in m.collect()}


def test_every_slot_holds_the_sequence_that_packing_by_hand_puts_there(spark, docs_df, monkeypatch):
    """Partition by partition: one stream of ids, cut every 32, sequence k at slot permute(k)."""
    monkeypatch.setattr(token_output, "WRITE_BYTES", 1_000)
    df = docs_df([(i, f"a text, number {i}. " * (i % 13)) for i in range(90)]).select("doc_id", "text")
    parts = df.rdd.glom().collect()
    with open(token_output.TOKENIZER, "rb") as f:
        enc = token_output.Encoder(f.read())
    want = []
    for rows in parts:
        ids = [x for r in rows for x in [*enc(r.text or ""), token_output.EOS]]
        owners = [r.doc_id for r in rows for _ in [*enc(r.text or ""), token_output.EOS]]
        for at in range(0, len(ids), 32):
            own = ids[at:at + 32]
            want.append((own + [token_output.EOS] * (32 - len(own)), len(own), list(dict.fromkeys(owners[at:at + 32]))))
    slots = token_output.permute(np.arange(len(want)), len(want), token_output.round_keys(token_output.KEY))
    m = token_output.write_shards(df, seq_len=32, shard_seqs=5)
    got = {r.slot: (r.tokens, r.n_tokens, r.doc_ids) for r in token_output.read_shards(m, seq_len=32).collect()}
    assert got == {int(s): w for s, w in zip(slots, want)}
    folder = m.first().folder
    names = {r.file for r in m.collect()}
    assert {x for x in os.listdir(folder.removeprefix("file:")) if x.endswith(".bin")} == names
    for name in names:      # a shard's bytes are its sequences in slot order
        rows = sorted((r.slot for r in m.collect() if r.file == name))
        with open(f"{folder.removeprefix('file:')}/{name}", "rb") as f:
            assert np.frombuffer(f.read(), "<u2").tolist() == [x for s in rows for x in got[s][0]]


def test_a_damaged_shard_is_an_error(docs_df):
    m = token_output.write_shards(docs_df([(i, "some text " * 40) for i in range(9)]), seq_len=32, shard_seqs=5)
    path = m.first().folder.removeprefix("file:") + "/" + m.first().file
    with open(path, "r+b") as f:
        f.seek(m.first().offset)
        f.write(b"\xff\xff")
    with pytest.raises(Exception, match="damaged sequence"):
        token_output.checked(m, seq_len=32).collect()


def test_long_texts_get_the_ids_of_the_whole_text():
    with open(token_output.TOKENIZER, "rb") as f:
        encode = token_output.Encoder(f.read())
    texts = ["some words of a text, it's long " * 3_000, "longwordwithoutspace" * 3_000, "好的。文字" * 9_000,
             "two  spaces\n\nand lines " * 2_000, "a" + " " * 50_000 + "b" + "\n" * 30_000 + "c",
             " \n" * 30_000, "x" + "\t" * 20_001]
    for t in texts:
        assert encode(t) == encode.full(t)


def test_no_documents_no_shards(docs_df):
    m = token_output.write_shards(docs_df([]))
    assert m.count() == 0 and token_output.checked(m).count() == 0


# ---------------------------------------------------------------- pipeline

def test_stages_keep_columns_and_take_effect(spark, docs_df, tmp_path):
    base = " ".join(f"the quick brown{i} fox" for i in range(60))
    leak = " ".join(f"item{i}" for i in range(20))
    rows = [(i, f"plain words number{i} of the document with its own tail{i} " * 5, "en", "s1") for i in range(60)]
    rows += [(100, base, "en", "s2"), (101, base.upper(), "en", "s2"), (102, "12345", "en", "s2"),
             (103, None, "en", "s2"), (104, f"some text before {leak} and after", "en", "s2")]
    docs = docs_df(rows)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    ids = lambda df: {r.doc_id for r in df.collect()}
    steps = dict(corpus_pipeline.STAGES)
    a = steps["language_id"](spark, docs, str(tmp_path))
    assert a.columns == docs.columns and ids(a) == ids(docs) - {102, 103}
    b = steps["near_dedup"](spark, a, str(tmp_path))
    fps = {i: simhash.fingerprint(t) for i, t, *_ in rows}
    group = {i: i for i in ids(a)}
    for _ in range(10):
        for x in group:
            for y in group:
                if (fps[x] ^ fps[y]).bit_count() <= 3:
                    group[x] = min(group[x], group[y])
    assert b.columns == docs.columns and ids(b) == set(group.values()) and 101 not in ids(b)
    c = steps["decontaminate"](spark, b, str(tmp_path))
    assert c.columns == docs.columns and ids(c) == ids(b) - {104}
    d = steps["mix_sources"](spark, c, str(tmp_path))
    assert d.columns == docs.columns and ids(d) <= ids(c)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x for r in whole for x in r.doc_ids} == ids(d)
    assert sorted(r.slot for r in whole) == list(range(len(whole)))


def full_search(items, texts):
    """(number of the text, item id) -> least distance, by the plain dynamic programme over all
    texts at once; gaps longer than any item keep them apart."""
    words, flat, starts = [words_of(t) for t in texts], [], []
    gap = [None] * (2 * max(len(words_of(t)) for _, t in items))
    for w in words:
        starts.append(len(flat))
        flat += w + gap
    ids = {w: i for i, w in enumerate({w for w in flat if w})}
    x, j = np.array([ids.get(w, -1) for w in flat]), np.arange(len(flat) + 1)
    out = {}
    for item, t in items:
        row, w = np.zeros(len(j), int), words_of(t)
        for i, a in enumerate(w, 1):
            new = np.r_[i, np.minimum(row[1:] + 1, row[:-1] + (x != ids.get(a, -2)))]
            row = np.minimum.accumulate(new - j) + j
        for n, (s, own) in enumerate(zip(starts, words)):
            if (least := row[s:s + len(own) + 1].min()) <= allowed(len(w)):
                out[n, item] = int(least)
    return out


def test_the_leak_query_equals_a_full_search_both_ways(spark):
    """All whole documents of the small table against all items: the query's rows, no more and no less."""
    sf = "/root/testdata/sf0.001"
    items = duckdb.sql(f"select item_id, text from '{sf}/benchmark.parquet'").fetchall()
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    want = {(docs[n][0], i): d for (n, i), d in full_search(items, [t for _, t in docs]).items()}
    rows = queries.op1_benchmark_decontamination(spark, sf).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in rows} == want and len(rows) == len(want)


def test_a_long_text_of_copies_is_scanned_in_bounded_memory(monkeypatch):
    """60 copies of a 600-word item in one text; small walk chunks change nothing."""
    rng = np.random.default_rng(0)
    item = " ".join(f"w{x}" for x in rng.integers(0, 3_000, 600))
    index, text = Index([(7, item)]), " filler words ".join([item] * 60)
    tracemalloc.start()
    got = index.scan([text, "filler"])
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert [(x[0], x[2]) for x in got[0]] == [(7, 0)] and got[1] == [] and peak < 500
    monkeypatch.setattr(decontamination, "WALK_BYTES", 1 << 16)
    assert index.scan([text, "filler"]) == got


def test_blocks_are_bounded_by_items_and_characters(spark):
    df = spark.createDataFrame([(i, "word " * (i % 4)) for i in range(10)] + [(99, None)], "item_id long, text string").coalesce(1)
    sizes = [len(b) for b in decontamination.blocks(df, size=4, chars=20)]
    assert sum(sizes) == 11 and max(sizes) <= 4 and len(sizes) >= 4
    assert all(sum(len(t or "") for _, t in b) <= 20 for b in decontamination.blocks(df, size=4, chars=20))


def test_leaks_equal_a_full_search_both_ways_with_planted_copies():
    """Whole texts and all items of the table, and copies with opening, middle and closing edits."""
    sf = "/root/testdata/sf0.001"
    items = duckdb.sql(f"select item_id, text from '{sf}/benchmark.parquet'").fetchall()
    texts = [t for t, in duckdb.sql(f"select text from '{sf}/documents.parquet'").fetchall()]
    planted = set()
    for i, t in items:
        w = words_of(t)
        k = allowed(len(w))
        for at in (0, (len(w) - k) // 2, len(w) - k):
            for new in ([], [f"zz{x}" for x in range(k)]):
                planted.add((len(texts), i))
                texts.append(" ".join(w[:at] + new + w[at + k:]))
    got = {(n, i): d for n, own in enumerate(Index(items).scan(texts)) for i, _, d, _ in own}
    assert planted <= set(got) and got == full_search(items, texts)


def test_suffix_and_simhash_queries_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    from .test_dedup import brute, slow_fingerprint
    want = dict(zip([d for d, _ in docs], brute([t for _, t in docs], 400)))
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256)
           for r in queries.op6_suffix_array_dedup(spark, sf).collect()}
    assert got == want
    near = queries.op7_simhash_near_dedup(spark, sf).collect()
    fps = {d: slow_fingerprint(t) for d, t in docs}
    assert {r.doc_id: r.fingerprint for r in near} == {d: f"{x:016x}" for d, x in fps.items()}
    low = {d: d for d in fps}
    changed = True
    while changed:
        changed = False
        for x in fps:
            for y in fps:
                if low[x] < low[y] and (fps[x] ^ fps[y]).bit_count() <= 3:
                    low[y], changed = low[x], True
    assert {r.doc_id: r.component_id for r in near} == low
