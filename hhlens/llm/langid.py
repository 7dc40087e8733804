"""Language identification, word first with back-off to character n-grams.

A word that the model knows scores its log frequency in every language.  An unseen word
falls back to character n-grams of its marked form (``_word_``): the longest length of which
the model knows some n-gram gives the mean log frequency of those; a word without any known
n-gram says nothing.  The sums over all words of the whole text give the posterior; the best
language and its posterior are the prediction.

Fitting uses a bounded sample of the labelled rows: about ``SAMPLE_ROWS`` distinct texts,
chosen by a hash of the text and spread over the languages (a language with less than its even
part gives all its texts, the others share what is left evenly), and of about ``SAMPLE_CHARS``
characters dealt in the same way, whichever is less.  Every word and n-gram of the sample is
kept; the sample bounds the broadcast model at every corpus size.  Prediction covers all rows.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every
text when there is nothing to learn from; equal scores go to the first language by code
point; labels that are null are not learned from.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import cut_lineage, fresh

SAMPLE_ROWS = 8_000
SAMPLE_CHARS = 32_000_000
LONGEST = 5
STRETCH = 400
SMOOTH = 0.5
CACHE = 100_000
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")


class Model:
    """Bounded tables of log frequencies, a row per word or n-gram and a column per language."""

    def __init__(self, langs: list[str], words: list[str], table: np.ndarray,
                 grams: list[str], gram_table: np.ndarray):
        self.langs, self.words, self.grams, self.gram_table = langs, words, grams, gram_table
        self.known, self.table = len(words), table
        self.row: dict[str, int] = {}
        self.gram_row: dict[str, int] = {}

    def _load(self) -> None:
        """Look-up tables; the rows after the known words cache up to CACHE unseen ones."""
        self.row = {w: i for i, w in enumerate(self.words)}
        self.gram_row = {g: i for i, g in enumerate(self.grams)}
        self.unseen: list[str] = []
        self.rows = np.concatenate([self.table, np.zeros((CACHE, len(self.langs)))])

    def _backoff(self, word: str) -> np.ndarray:
        marked = f"_{word}_"
        for n in range(LONGEST, 0, -1):
            found = [g for i in range(len(marked) - n + 1)
                     if (g := self.gram_row.get(marked[i:i + n])) is not None]
            if found:
                return self.gram_table[found].mean(axis=0)
        return np.zeros(len(self.langs))

    def _sum(self, words: list[str]) -> np.ndarray:
        """At most CACHE words."""
        found = list(map(self.row.get, words))
        if None in found:
            new = {w for w, i in zip(words, found) if i is None}
            if len(self.unseen) + len(new) > CACHE:
                for w in self.unseen:
                    del self.row[w]
                self.unseen, new = [], {w for w in words if w not in self.row}
            for w in new:
                i = self.row[w] = self.known + len(self.unseen)
                self.unseen.append(w)
                self.rows[i] = self._backoff(w)
            found = [self.row[w] for w in words]
        return self.rows[found].sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _WORD.findall(text.lower()) if text else []
        # Some numerals (superscripts, fractions) pass the pattern but are no letters.
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        if not self.row:
            self._load()
        total = np.zeros(len(self.langs))
        for i in range(0, len(words), CACHE):
            total = total + self._sum(words[i:i + CACHE])
        best = int(np.argmax(total))
        return self.langs[best], float(1.0 / np.exp(total - total[best]).sum())


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learns from the columns text and lang."""
    rows = labelled.where("lang is not null and text is not null").select("text", "lang")
    counts, chars = {}, {}
    for lang, n, size in rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02),
                                                  F.avg(F.length("text"))).collect():
        counts[lang], chars[lang] = n, n * size
    if not counts:
        return Model([], [], np.zeros((0, 0)), [], np.zeros((0, 0)))
    by_rows, by_chars = _shares(counts, sample_rows), _shares(chars, sample_chars)
    shares = [x for lang in counts for x in (
        F.lit(lang), F.lit(max(1, round(min(by_rows[lang], by_chars[lang]) * (1 << 40)))))]
    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 40))
                        < F.element_at(F.create_map(*shares), F.col("lang"))).distinct()
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    words = cut_lineage(sample.select("lang", F.explode(found).alias("w")).groupBy("w", "lang")
                        .agg(F.count("*").alias("n")))
    # Long words go in stretches (a substring is sought from its text's start); n-grams belong
    # to the stretch that they start in.
    marked = words.select("lang", "n", F.concat(F.lit("_"), "w", F.lit("_")).alias("m"))
    at = F.explode(F.sequence(F.lit(1), F.length("m"), F.lit(STRETCH))).alias("at")
    marked = marked.select("lang", "n", "m", at).select(
        "lang", "n", "at", F.substring("m", F.col("at"), F.lit(STRETCH + LONGEST - 1)).alias("m"))
    pieces = [_pieces(k) for k in range(1, LONGEST + 1)]
    grams = marked.select("lang", "n", F.explode(F.concat(*pieces)).alias("w")).where("w <> '_'").groupBy(
        "w", "lang").agg(F.sum("n").alias("n"))
    langs = sorted(r[0] for r in words.select("lang").distinct().collect())
    return Model(langs, *_log_rows(words, langs), *_log_rows(grams, langs))


def _pieces(k: int) -> Column:
    """The n-grams of length k that start in a stretch m."""
    starts = F.least(F.length("m") - k + 1, F.lit(STRETCH))
    # One parameter only: transform passes the index to a second one, default or not.
    found = F.transform(F.sequence(F.lit(1), F.greatest(starts, F.lit(1))), lambda i: F.substring("m", i, F.lit(k)))
    return F.when(starts >= 1, found).otherwise(F.array().cast("array<string>"))


def _shares(counts: dict[str, float], rows: int) -> dict[str, float]:
    """The share of each language's texts in a sample of ``rows`` (or characters), dealt evenly
    from the rarest language on."""
    out, left = {}, rows
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        part = left / (len(counts) - i)
        out[lang] = min(1.0, part / max(n, 1))
        left -= min(n, part)
    return out


def _log_rows(counts: DataFrame, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """All entries of the (bounded) sample with their log frequency per language, in order."""
    totals = dict(counts.groupBy("lang").agg(F.sum("n")).collect())
    own = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"l{i}")
           for i, x in enumerate(langs)]
    top = counts.groupBy("w").agg(*own).toArrow().sort_by("w")
    kinds = top.num_rows
    found = np.stack([top.column(f"l{i}").to_numpy() for i in range(len(langs))], axis=1)
    norm = np.array([totals.get(x, 0) + SMOOTH * kinds for x in langs])
    return top.column("w").to_pylist(), np.log((found + SMOOTH) / norm)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus lang_pred and score (which must be free names)."""
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.langs, model.words, model.table, model.grams, model.gram_table))
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for b in batches:
            out = [m.predict(t.as_py()) for t in b.column(text)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.float64())],
                names=[*b.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_identified(docs: DataFrame, min_score: float | None = None) -> DataFrame:
    """The documents whose language is found; columns as given.

    Rejected: ``und``, and a score under ``min_score`` (by default one that is no better than
    chance, which says that no word and no n-gram of the text is known)."""
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    names = {c: fresh(f"_in{i}", docs.columns) for i, c in enumerate(docs.columns)}
    scored = predict(docs.withColumnsRenamed(names), model, names["text"])
    if min_score is None:
        min_score = 0.0 if len(model.langs) < 2 else 1.000001 / len(model.langs)
    kept = scored.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score))
    return kept.select(*[F.col(v).alias(k) for k, v in names.items()])
