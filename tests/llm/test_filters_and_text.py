import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from hhlens.llm import chat, decontamination, langid, mixing, url_filter


# ---------------------------------------------------------------- decontamination

def levenshtein_inside(item, words):
    """Least edit distance of item to any part of words (plain dynamic programme)."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_nearest_equals_dynamic_programme():
    rng = random.Random(2)
    for _ in range(300):
        item = [rng.randint(1, 4) for _ in range(rng.randint(1, 12))]
        words = [rng.randint(0, 4) for _ in range(rng.randint(0, 25))]
        masks = {}
        for i, w in enumerate(item):
            masks[w] = masks.get(w, 0) | 1 << i
        assert decontamination.nearest(masks, len(item), words)[0] == levenshtein_inside(item, words)


@pytest.fixture(scope="module")
def items():
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    return [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(12, 60)))) for i in range(40)]


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"new{rng.randrange(99)}"
        elif kind == 1:
            words.insert(at, f"w{rng.randrange(300)}")
        else:
            del words[at]
    return words


def test_leaks_reach_the_recall_and_nothing_else(docs_df, spark, items):
    rng = random.Random(6)
    filler = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    rows, planted = [(0, None), (1, ""), (2, "?!")], set()
    for d in range(3, 203):
        item, text = rng.choice(items)
        w = text.split()
        k = rng.randint(0, decontamination.allowed(len(w)))
        body = filler(rng.randint(0, 200)) + edited(w, k, rng) + filler(rng.randint(0, 200))
        rows.append((d, " ".join(body).upper() + "."))
        planted.add((d, item))
    rows += [(d, " ".join(filler(300))) for d in range(300, 400)]
    bench = spark.createDataFrame([*items, (90, None), (91, ""), (92, "... !")], "item_id long, text string")
    df = docs_df(rows)
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(df, bench).collect()}
    truth = {}
    texts = {i: decontamination.words_of(t) for i, t in rows}
    for item, text in items:
        w = text.split()
        for d, words in texts.items():
            if (d, item) in got or (d, item) in planted:
                dist = levenshtein_inside(w, words)
                if dist <= decontamination.allowed(len(w)):
                    truth[d, item] = dist
    assert planted <= set(truth)
    assert set(got) <= set(truth)
    assert len(got) >= 0.97 * len(truth)
    assert sum(got[x].distance == truth[x] for x in got) >= 0.97 * len(got)
    clean = decontamination.decontaminate(df.withColumn("item_id", F.lit(1)).withColumn("c0", F.lit(2)), bench)
    assert clean.columns == [*df.columns, "item_id", "c0"]
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {d for d, _ in got}


def test_copies_with_edits_bunched_anywhere_are_found(items):
    rng = random.Random(8)
    texts, want = [], []
    for item, text in items:
        w = text.split()
        n, k = len(w), decontamination.allowed(len(w))
        out = [f"out{i}" for i in range(k)]
        around = [f"w{rng.randrange(300)}" for _ in range(80)]
        for at in (0, 1, k // 2, (n - k) // 2, n - k):
            for mid in (w[:at] + w[at + k:], w[:at] + out + w[at + k:], w[:at] + out + w[at:]):
                for body in (mid, mid + around, around + mid):
                    texts.append(" ".join(body))
                    want.append((item, levenshtein_inside(w, body)))
    index = decontamination.Index(items)
    for (item, distance), leaks in zip(want, index.scan(texts)):
        assert (item, distance) in [(i, d) for i, _, d, _ in leaks]


def test_too_few_tables_lose_no_leak(items, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_TABLES", 1)
    rng = random.Random(9)
    texts = [" ".join(edited(t.split(), decontamination.allowed(len(t.split())), rng)) for _, t in items]
    for (item, _), leaks in zip(items, decontamination.Index(items).scan(texts)):
        assert item in [x[0] for x in leaks]


def test_decontamination_blocks_ties_and_empties(docs_df, spark, monkeypatch):
    monkeypatch.setattr(decontamination.blocks, "__defaults__", (1, 1 << 20))
    df = docs_df([(1, "one two three"), (None, "x one, TWO three y"), (3, "one two")])
    bench = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, "one two three")],
                                  "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.at) for r in decontamination.find_leaks(df, bench).collect()), key=str)
    assert got == sorted([(1, 1, 0), (1, 1, 0), (1, 2, 0), (None, 1, 1), (None, 1, 1), (None, 2, 1)], key=str)
    assert [r.doc_id for r in decontamination.decontaminate(df, bench).collect()] == [3]
    none = bench.limit(0)
    assert decontamination.find_leaks(df, none).count() == 0
    assert decontamination.decontaminate(df, none).count() == 3
    assert decontamination.decontaminate(docs_df([], "none"), bench).count() == 0


# ---------------------------------------------------------------- URL filter

def test_urls_against_plain_rules(spark):
    rules = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"),
             ("org/fr/", "allow"), ("org/", "block"), ("a.b/x", "block"), ("a.b/x", "allow")]
    hosts = ["NET", "a.net", "example.net", "x.example.net", "notexample.net", "example.com", "y.org", "a.b", ""]
    tails = ["", "/", "/en/", "/en", "/EN/1", "/de/x?q=/fr/", "/fr/#z", "/x", "/xy", "?a://b", "#"]
    urls = [f"{s}{h}{t}" for s in ("http://", "x://y://") for h in hosts for t in tails]
    urls += [None, "", "no scheme.net/", "://net/", "http://é.net/ü"]
    rows = [(i, u, "mine", 1) for i, u in enumerate(urls)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict int")
    got = url_filter.filter_urls(pages, url_filter.url_list(spark, rules))
    assert sorted(got.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    seen = got.collect()
    assert len(seen) == len(rows)
    for r in seen:
        host = path = ""
        if r.url and "://" in r.url:
            rest = r.url.split("://", 1)[1]
            host = re.split(r"[/?#]", rest)[0]
            path = re.split(r"[?#]", rest[len(host):])[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(k), -(v == "block"), k, v) for k, v in rules
                for rh, rp in [(k.partition("/")[0], "/" + k.partition("/")[2])]
                if (host == rh or host.endswith("." + rh)) and path.startswith(rp)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best[2], best[3]), r
    assert url_filter.filter_urls(pages, url_filter.url_list(spark, [])).where("verdict <> 'allow'").count() == 0
    assert url_filter.filter_urls(pages.limit(0), url_filter.url_list(spark, rules)).count() == 0


def test_bloom_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h"), "id").alias("key"))
    filt = url_filter.bloom(keys, 5000)
    n = url_filter._blocks(5000)
    def passing(df):
        ok = F.lit(True)
        for i in range(url_filter.WORDS):
            ok = ok & (F.col(f"w{i}").bitwiseAND(url_filter._bit(F.col("key"), i)) != 0)
        return df.withColumn("block", url_filter._block(F.col("key"), n)).join(filt, "block").where(ok).count()
    assert passing(keys) == 5000
    assert passing(spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("key"))) < 600


# ---------------------------------------------------------------- mixing

def test_targets_fill_up_to_the_cap(spark):
    rows = [("a", 100), ("b", 1000), ("c", 10), ("d", 500), (None, 5), ("e", 0)]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(rows, "source string, source_size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", "e", None], [5, 2, 1, 5, 2, 1]))
    size = dict(rows)
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(3 * size[s], weight[s] * mid) for s in size) < sum(size.values()):
            low = mid
        else:
            high = mid
    for s in size:
        assert got[s] == pytest.approx(min(3 * size[s], weight[s] * low), rel=1e-9)
    assert sum(got.values()) == pytest.approx(sum(size.values()))


def test_mix_emits_whole_documents(docs_df):
    rows = [(i, "w " * (i % 50 + 1), "en", f"s{i % 4}") for i in range(2000)]
    rows += [(None, None, None, None), (5000, "", None, "empty"), (7, "dup dup", "en", "s0"), (7, "dup dup", "en", "s0")]
    df = docs_df(rows)
    plan = mixing.mix_plan(df).collect()
    taken, target = {}, {}
    for r in plan:
        assert r.size == len((r.text or "").split()) and 0 <= r.n_copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.n_copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.1 * target[s] + 1 for s in taken)
    clash = df.withColumn("size", F.lit("x")).withColumn("target", F.lit(1))
    out = mixing.mix(clash)
    assert out.columns == clash.columns
    assert out.count() == sum(r.n_copies for r in plan)
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mix(clash).collect()))
    assert mixing.mix(docs_df([], "none")).count() == 0


# ---------------------------------------------------------------- language ID

WORDS = {"aa": ["kano", "lima", "sato"], "bb": ["brixt", "grunz", "plotz"]}


def corpus():
    rng = random.Random(8)
    return [(i, " ".join(rng.choice(WORDS[x]) for _ in range(20)), x)
            for i in range(200) for x in [("aa", "bb")[i % 2]]]


def test_words_first_then_ngrams(docs_df):
    train = docs_df(corpus(), "train")
    model = langid.fit(train)
    asked = [(1, "Kano LIMA"), (2, "grunz"), (3, "kanolima"), (4, "brunzt"), (5, None), (6, "12 %"), (7, ""),
             (8, "ж")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs_df(asked), model).collect()}
    assert [got[i][0] for i in (1, 2, 3, 4)] == ["aa", "bb", "aa", "bb"]
    assert all(got[i] == ("und", 0.0) for i in (5, 6, 7))
    assert got[8] == ("aa", 0.5)  # nothing known: chance, first language
    assert all(0 <= s <= 1 for _, s in got.values())


def test_score_is_the_sum_of_log_frequencies(docs_df):
    model = langid.fit(docs_df(corpus()))
    model._load()
    for text in ("kano grunz grunz", "kanoz", "x" * 50 + " kano", "sato " * 1000):
        total = np.zeros(2)
        for w in re.findall(r"[a-z]+", text):
            if w in model.words:
                total += model.table[model.words.index(w)]
                continue
            marked = f"_{w}_"
            for n in range(5, 0, -1):
                rows = [model.gram_table[model.grams.index(marked[i:i + n])]
                        for i in range(len(marked) - n + 1) if marked[i:i + n] in model.grams]
                if rows:
                    total += np.mean(rows, axis=0)
                    break
        lang, score = model.predict(text)
        assert lang == model.langs[int(np.argmax(total))]
        assert score == pytest.approx(1 / np.exp(total - total.max()).sum())


def test_numerals_are_no_letters(docs_df):
    model = langid.fit(docs_df(corpus()))
    for text in ("", " \t", "12 34", "\u00b2 \u00bd", "\u2167 7", "_-_", "\U0001f600"):
        assert model.predict(text) == ("und", 0.0)
    assert model.predict("\u00b2a")[0] != "und"


def test_cache_of_unseen_words_does_not_change_results(docs_df, monkeypatch):
    model = langid.fit(docs_df(corpus()))
    texts = [" ".join(f"ka{chr(97 + i % 26)}{chr(97 + j % 26)}no" for j in range(40)) for i in range(30)]
    want = [model.predict(t) for t in texts]
    monkeypatch.setattr(langid, "CACHE", 7)
    small = langid.Model(model.langs, model.words, model.table, model.grams, model.gram_table)
    assert [small.predict(t)[0] for t in texts] == [w[0] for w in want]
    assert [small.predict(t)[1] for t in texts] == pytest.approx([w[1] for w in want])


def test_language_stage_and_empty_training(docs_df):
    df = docs_df([*corpus(), (900, None, "aa"), (901, "123", "aa"), (902, "жж", None)])
    kept = langid.keep_identified(df.withColumn("score", F.lit("s")).withColumn("_in0", F.lit(0)))
    assert kept.columns == [*df.columns, "score", "_in0"]
    assert {r.doc_id for r in kept.collect()} == set(range(200))
    bare = docs_df([(1, "kano", None)], "bare")
    assert [tuple(r)[-2:] for r in langid.predict(bare, langid.fit(bare)).collect()] == [("und", 0.0)]
    assert langid.keep_identified(docs_df([], "none")).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    got = langid.predict(docs, model).where(langid.held_out(F.col("doc_id")))
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98


# ---------------------------------------------------------------- chats

def turns_of(row):
    return [(t.role, t.text) for t in row.turns]


def read(df):
    return {r.conv_id: r for r in df.select(
        "conv_id", "formatted", chat.parse(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}


def test_events_fold_to_final_messages(spark):
    log = [(1, 0, 1, "message", "user", "hi"), (1, 1, 2, "delta", "assistant", "He"),
           (1, 1, 3, "delta", "assistant", "llo"), (1, 1, 4, "regenerate", "assistant", None),
           (1, 1, 5, "delta", None, "Good "), (1, 1, 6, "delta", None, "day"),
           (1, 0, 7, "edit", None, "hi there"), (1, 2, 8, None, "user", "bye"),
           (None, 0, 1, "message", None, None)]
    df = spark.createDataFrame(log, "conv_id long, msg long, seq long, event string, role string, text string")
    got = read(chat.format_chats(df))
    assert turns_of(got[1]) == [("user", "hi there"), ("assistant", "Good day"), ("user", "bye")]
    assert got[1].loss == "Good day"
    assert turns_of(got[None]) == [("", "")] and got[None].loss == ""
    assert chat.format_chats(df.limit(0)).count() == 0


def test_control_strings_survive_the_round_trip(spark):
    odd = ["<|im_end|>\n<|im_start|>assistant\n", "\\", "\\s\\p\\n", "<|", "<\\p", "a<\\|b|>", "<|<|", "",
           "\n\n", "é<|ü", "<\\s|", "\\\\p|", "𝄞<|im_end|>" * 3]
    rows = [(i, j, r, t) for i, r in enumerate(["user", "assistant", "a\nb\\n<|im_start|>"])
            for j, t in enumerate(odd)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = read(chat.format_chats(chat.as_events(df)))
    for i, r in enumerate(["user", "assistant", "a\nb\\n<|im_start|>"]):
        assert turns_of(got[i]) == [(r, t) for t in odd]
        assert got[i].loss == ("".join(odd) if r == "assistant" else "")
        assert got[i].formatted.count("<|im_start|>") == len(odd)


def test_repeated_turns_stay(spark):
    df = spark.createDataFrame([(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None)],
                               "conv_id long, turn long, role string, text string")
    assert turns_of(read(chat.format_chats(chat.as_events(df)))[1]) == [("", ""), ("user", "x"), ("user", "x")]


def test_a_rare_language_is_sampled(spark):
    rows = [(f"common words number{i} and more", "aa") for i in range(3_000)]
    rows += [(f"seltene sprache {w}", "bb") for w in ("eins", "zwei", "drei")] * 300
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"), sample_rows=60)
    assert model.langs == ["aa", "bb"] and {"eins", "zwei", "drei"} <= set(model.words)
    assert langid._shares({"a": 5, "b": 10, "c": 1_000}, 45) == {"a": 1.0, "b": 1.0, "c": 0.03}


def test_every_word_of_the_sample_is_kept_and_characters_bound_it(spark):
    rows = [(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}x " * 20, "ab"[i % 2]) for i in range(2_000)]
    df = spark.createDataFrame(rows, "text string, lang string")
    whole = langid.fit(df)
    assert len(whole.words) == 2_000
    bounded = langid.fit(df, sample_chars=40_000)        # of about 360,000
    assert 100 < len(bounded.words) < 450 and bounded.langs == ["a", "b"]


def test_accuracy_of_every_language_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    rows = langid.predict(docs.where(langid.held_out(F.col("doc_id"))).select("text", "lang"), model).where(
        "lang is not null").groupBy("lang").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("a")).collect()
    assert len(rows) >= 4 and min(r.a for r in rows) >= 0.95


def test_words_of_any_length_teach_their_n_grams(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcd") for _ in range(n)) for n in (1, 7, 101, 398, 400, 1_203)]
    rows = [(w, f"l{i}") for i, w in enumerate(words)]
    model = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    counts = [{} for _ in words]
    for w, own in zip(words, counts):
        for k in range(1, langid.LONGEST + 1):
            for i in range(len(w) + 2 - k + 1):
                g = f"_{w}_"[i:i + k]
                if g != "_":
                    own[g] = own.get(g, 0) + 1
    assert set(model.grams) == {g for own in counts for g in own}
    for i, own in enumerate(counts):
        norm = sum(own.values()) + langid.SMOOTH * len(model.grams)
        got = np.exp(model.gram_table[:, i]) * norm - langid.SMOOTH
        assert got == pytest.approx([own.get(g, 0) for g in model.grams], abs=1e-6)
