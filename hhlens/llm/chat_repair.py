"""Conversation structure repair by grammar-compressed dynamic programming.

A row is a symbol: its role class (s, u, a, other) and whether it is sound, truncated or has
to go (blank, duplicate).  A conversation is a word over nine symbols.  Its cheapest edits
into ``(s?(ua)+)?`` are a product of 4 x 4 min-plus transfer matrices over the states
0 nothing yet, 1 after a system turn, 2 after a user turn, 3 after an assistant turn; an
entry holds the cost and the ASCII-least audit (edit initials) as a rope.  In one entry no
audit of least cost is a proper prefix of another (what it had in front would be inserts
around a cycle, which cost), so least ropes of the parts make the least rope of the whole.

1. Symbols: short keys only (id, turn, role, text digest) are shuffled; equal rows collapse
   map-side; the first turn of each repeated (role, digest) marks the later ones.
2. Range partitions over (id, turn, role, digest) cut a long conversation into chunks, each
   streamed in order.  Only its first and last conversation can go on in another partition.
3. Re-Pair: rounds over all chunks replace the most frequent symbol pairs that do not touch
   each other by new symbols.  Each rule gets one matrix, made bottom-up from its two parts
   and shared by all conversations; a chunk is the balanced product of its few symbols.
4. Chunks at partition ends report their matrix, which is folded per conversation in order.
5. The rows meet their audit once, sorted, and stream through it: repaired turns, or digests.
   SHA-256 reads its input in one sequence, so one task streams a conversation's rows (not
   held: memory is one batch and the audit); the dynamic programme itself has no such task.

Defined cases: null role or text is one space (so blank, and no known role); rows of one turn
are taken by role, then by SHA-256 of the text; null turns first; a null id is a conversation
of its own; ids without any row get zeros, an empty audit and the digest of nothing; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

SPACE = " \t\n\x0b\f\r"
STATES = 4
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
GONE = "D"                              # symbol of a row that has to go
TO_USER, TO_ASSISTANT = (0, 1, 3), (2,)     # states that a user (assistant) turn may follow
#: Rounds and rules of the grammar: they change the work shared, never a result.
ROUNDS, MAX_RULES = 12, 512
FIRST_RULE = 0xE000                     # rule symbols are private-use characters
OUT_ROWS, NEWLINE = 2_000, "\n"


# ------------------------------------------------------------------ ropes and matrices
class Rope:
    """An immutable string by its parts, with a hash of its text."""
    __slots__ = ("left", "right", "text", "n", "h", "power")
    MOD, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E68

    def __init__(self, text="", left=None, right=None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.n, self.h, self.power = len(text), 0, 1
            for c in text:
                self.h = (self.h * self.BASE + ord(c)) % self.MOD
                self.power = self.power * self.BASE % self.MOD
        else:
            self.n = left.n + right.n
            self.h = (left.h * right.power + right.h) % self.MOD
            self.power = left.power * right.power % self.MOD

    def __add__(self, other: Rope) -> Rope:
        return other if not self.n else self if not other.n else Rope(None, self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            r = todo.pop()
            if r.left is None:
                out.append(r.text)
            else:
                todo += [r.right, r.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        """ASCII order; parts with the same length and hash are passed over whole."""
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.n == y.n and x.h == y.h):
                continue
            if x.left is None and y.left is None:
                k = min(x.n, y.n)
                if x.text[:k] != y.text[:k]:
                    return x.text < y.text
                if x.n > k:
                    a.append(Rope(x.text[k:]))
                elif y.n > k:
                    b.append(Rope(y.text[k:]))
            elif y.left is None or (x.left is not None and x.n >= y.n):
                a += [x.right, x.left]
                b.append(y)
            else:
                b += [y.right, y.left]
                a.append(x)
        return bool(b) and not a


Matrix = list   # of STATES rows of entries, each None or (cost, Rope)


def better(x, y):
    if x is None or y is None:
        return x or y
    return y if y[0] < x[0] or (y[0] == x[0] and y[1] < x[1]) else x


def times(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for row in a:
        line = [None] * STATES
        for m, x in enumerate(row):
            if x is not None:
                for to, y in enumerate(b[m]):
                    if y is not None:
                        line[to] = better(line[to], (x[0] + y[0], x[1] + y[1]))
        out.append(line)
    return out


def _matrix(moves) -> Matrix:
    out = [[None] * STATES for _ in range(STATES)]
    for a, b, cost, text in moves:
        out[a][b] = better(out[a][b], (cost, Rope(text)))
    return out


@lru_cache(1)
def inserts() -> Matrix:
    """Any number of inserted turns (none, one or two are enough to reach every state)."""
    one = _matrix([(x, 2, COST[INSERT], INSERT) for x in TO_USER] + [(x, 3, COST[INSERT], INSERT) for x in TO_ASSISTANT]
                  + [(x, x, 0, "") for x in range(STATES)])
    return times(one, one)


@lru_cache(None)
def symbol_matrix(symbol: str) -> Matrix:
    """Inserts, then one edit of the row: ``D``, or the role class (upper case: truncated)."""
    moves = [(x, x, COST[DELETE], DELETE) for x in range(STATES)]
    if symbol != GONE:
        role, more = symbol.lower(), TRUNCATED_COST if symbol.isupper() else 0
        keep = {"s": [(0, 1)], "u": [(x, 2) for x in TO_USER], "a": [(x, 3) for x in TO_ASSISTANT]}
        moves += [(x, y, COST[KEEP] + more, KEEP) for x, y in keep.get(role, [])]
        moves += [(x, 2, COST[REROLE] + more, REROLE) for x in TO_USER]
        moves += [(x, 3, COST[REROLE] + more, REROLE) for x in TO_ASSISTANT]
    return times(inserts(), _matrix(moves))


Grammar = tuple     # of pairs; rule k is the character FIRST_RULE + k


def compress(word: str, grammar: Grammar, start: int = 0) -> str:
    for k, pair in enumerate(grammar[start:], start):
        if len(word) < 2:
            break
        word = word.replace(pair, chr(FIRST_RULE + k))
    return word


@lru_cache(4)
def rule_matrices(grammar: Grammar) -> dict[str, Matrix]:
    """One matrix per rule, bottom-up: a rule's parts are symbols or earlier rules."""
    out: dict[str, Matrix] = {}
    for k, (x, y) in enumerate(grammar):
        out[chr(FIRST_RULE + k)] = times(out.get(x) or symbol_matrix(x), out.get(y) or symbol_matrix(y))
    return out


@lru_cache(50_000)
def _product(word: str, grammar: Grammar) -> Matrix:
    rules = rule_matrices(grammar)
    level = [rules.get(c) or symbol_matrix(c) for c in word]
    while len(level) > 1:
        pairs = [times(a, b) for a, b in zip(level[::2], level[1::2])]
        level = pairs + level[len(pairs) * 2:]
    return level[0]


def word_matrix(word: str, grammar: Grammar = ()) -> Matrix:
    """Transfer matrix of a non-empty word of symbols."""
    short = compress(word, grammar)
    return (_product if len(short) <= 64 else _product.__wrapped__)(short, grammar)


def cheapest(matrix: Matrix) -> tuple[int, str]:
    """Cost and audit of a whole conversation: end after an assistant turn, or with nothing."""
    row = times(matrix[:1], inserts())[0]
    cost, audit = better(row[0], row[3])
    return cost, str(audit)


# ------------------------------------------------------------------ symbols
def _rows(turns: DataFrame) -> DataFrame:
    """c, turn, role, text, h (digest of the text)."""
    space = lambda name: F.coalesce(F.col(name), F.lit(" "))
    return turns.select(F.col("conv_id").alias("c"), "turn", space("role").alias("role"), space("text").alias("text")
                        ).withColumn("h", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _order(*front: str) -> list[Column]:
    return [F.col(x).asc_nulls_first() for x in (*front, "turn", "role", "h")]


def _runs(rows: DataFrame) -> DataFrame:
    """One row per (c, turn, role, h): copies, role class, fault (0 none, 1 truncated, 2 blank,
    3 seen in an earlier turn)."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    head = F.substring("role", 1, 1)
    runs = rows.select(
        "c", "turn", "role", "h", F.when(head.isin("s", "u", "a"), head).otherwise("o").alias("cls"),
        F.when(last == "", 2).when(last.isin(".", "!", "?"), 0).otherwise(1).alias("fault"))
    runs = cut_lineage(runs.groupBy("c", "turn", "role", "h").agg(
        F.count("*").alias("m"), F.min("cls").alias("cls"), F.min("fault").alias("fault")))
    again = runs.groupBy("c", "role", "h").agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("f")).where(
        "n > 1").select(F.col("c").alias("_c"), F.col("role").alias("_r"), F.col("h").alias("_h"), "f")
    both = runs.join(again, F.col("c").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r"))
                     & (F.col("h") == F.col("_h")), "left")
    late = F.col("f").isNotNull() & ~F.col("f.turn").eqNullSafe(F.col("turn"))
    return both.select("c", "turn", "role", "h", "m", "cls",
                       F.when((F.col("fault") < 2) & late, 3).otherwise(F.col("fault")).alias("fault"))


COUNTS = ("blank", "duplicate", "truncated", "illegal")
LEGAL = {"su", "ua", "au"}


class _Chunk:
    """What one partition holds of a conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.symbols, self.edge = conv, [], False
        self.n = dict.fromkeys(COUNTS, 0)
        self.first = self.last = None
        self.turns, self.lo, self.hi, self.turn = 0, None, None, None

    def add(self, turn, m, cls, fault):
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.lo, self.hi, self.turn = turn if self.lo is None else self.lo, turn, turn
        if fault == 2:
            self.n["blank"] += m
        else:
            self.n["duplicate"] += m - (fault != 3)
            self.n["truncated"] += fault == 1
        self.n["illegal"] += m - 1 + (self.last is not None and self.last + cls not in LEGAL)
        self.first, self.last = self.first or cls, cls
        head = GONE if fault > 1 else cls.upper() if fault else cls
        self.symbols.append(head + GONE * (m - 1))


CHUNK = ("pid int, edge boolean, word string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
         "first string, last string, turns bigint, lo bigint, hi bigint")


def _chunks(runs: DataFrame) -> DataFrame:
    """A row per conversation and range partition: its symbols in order and what is counted."""
    spark, key = runs.sparkSession, runs.schema["c"].dataType.simpleString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ["c", *[x.split()[0] for x in CHUNK.split(", ")]]
    arrow = None

    def batch(done: list[_Chunk], pid: int) -> pa.RecordBatch:
        cols = [[x.conv for x in done], [pid] * len(done), [x.edge for x in done], ["".join(x.symbols) for x in done],
                *[[x.n[k] for x in done] for k in COUNTS], *[[getattr(x, k) for x in done]
                                                             for k in ("first", "last", "turns", "lo", "hi")]]
        types = [arrow, pa.int32(), pa.bool_(), pa.string(), *[pa.int64()] * 4, pa.string(), pa.string(), *[pa.int64()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal arrow
        now, done, pid, any_done = None, [], 0, False
        for b in batches:
            arrow = b.schema.field("c").type
            cols = [b.column(x).to_pylist() for x in ("c", "turn", "m", "cls", "fault", "pid")]
            for c, turn, m, cls, fault, pid in zip(*cols):
                if now is None or c != now.conv:
                    if now is not None:
                        now.edge = not any_done
                        any_done = True
                        done.append(now)
                        if len(done) >= 5_000:
                            yield batch(done, pid)
                            done = []
                    now = _Chunk(c)
                now.add(turn, m, cls, fault)
        if now is not None:
            now.edge = True
            yield batch([*done, now], pid)

    order = _order("c")
    ranged = runs.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())
    return cut_lineage(ranged.select("c", F.col("turn").cast("bigint").alias("turn"), "m", "cls", "fault", "pid")
                       .mapInArrow(run, f"c {key}, {CHUNK}"))


# ------------------------------------------------------------------ grammar and audits
def learn_grammar(words: DataFrame, rounds: int = ROUNDS, max_rules: int = MAX_RULES) -> Grammar:
    """Re-Pair over all rows of ``words`` (one string column): per round the most frequent
    pairs that share no symbol side with a more frequent one become rules.  Pair counts are
    aggregated; at most ``max_rules`` of them reach the driver."""
    column, grammar = words.columns[0], ()
    for _ in range(rounds):
        def count(batches: Iterator[pa.RecordBatch], grammar=grammar) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for b in batches:
                for word, k in Counter(b.column(0).to_pylist()).items():
                    w = compress(word or "", grammar)
                    own = Counter(map(str.__add__, w, w[1:]))
                    for pair in own:
                        if pair[0] == pair[1]:
                            own[pair] = w.count(pair)
                    for pair, n in own.items():
                        seen[pair] += n * k
            yield pa.RecordBatch.from_pydict({"pair": pa.array(list(seen), pa.string()),
                                              "n": pa.array(list(seen.values()), pa.int64())})

        top = words.select(column).mapInArrow(count, "pair string, n bigint").groupBy("pair").agg(
            F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair").limit(max_rules).collect()
        firsts, seconds, new = set(), set(), []
        for r in top:
            x, y = r.pair
            if len(grammar) + len(new) < max_rules and x not in seconds and y not in firsts:
                firsts.add(x)
                seconds.add(y)
                new.append(r.pair)
        if not new:
            break
        grammar += tuple(new)
    return grammar


HEADER = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _gaps(turns: int, lo, hi) -> int:
    return 0 if lo is None else min(hi - lo + 1 - turns, (1 << 63) - 1)


def _audits(chunks: DataFrame, grammar: Grammar) -> DataFrame:
    """c and HEADER for every conversation that has rows."""
    key = chunks.schema["c"].dataType.simpleString()
    names = ["c", *[x.split()[0] for x in HEADER.split(", ")]]
    types = [*[pa.int64()] * 6, pa.string()]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            best = [cheapest(word_matrix(w, grammar)) for w in b.column("word").to_pylist()]
            gaps = [_gaps(*x) for x in zip(*[b.column(k).to_pylist() for k in ("turns", "lo", "hi")])]
            cols = [gaps, *[b.column(k) for k in COUNTS], [x[0] for x in best], [x[1] for x in best]]
            yield pa.RecordBatch.from_arrays(
                [b.column("c"), *[v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(cols, types)]], names=names)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            entries = [[e for row in word_matrix(w, grammar) for e in row] for w in b.column("word").to_pylist()]
            costs = pa.array([[e and e[0] for e in x] for x in entries], pa.list_(pa.int64()))
            ropes = pa.array([[e and str(e[1]) for e in x] for x in entries], pa.list_(pa.string()))
            keep = [k for k in b.schema.names if k != "word"]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keep], costs, ropes], names=[*keep, "costs", "ropes"])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, key_type = None, None

        def end():
            cost, audit = cheapest(now["m"])
            vals = [_gaps(now["turns"], now["lo"], now["hi"]), *[now[k] for k in COUNTS], cost, audit]
            return pa.RecordBatch.from_arrays(
                [pa.array([now["c"]], key_type), *[pa.array([v], t) for v, t in zip(vals, types)]], names=names)

        for b in batches:
            key_type = b.schema.field("c").type
            for r in b.to_pylist():
                cells = [None if c is None else (c, Rope(t)) for c, t in zip(r.pop("costs"), r.pop("ropes"))]
                r["m"] = [cells[i:i + STATES] for i in range(0, STATES * STATES, STATES)]
                if now is None or now["c"] != r["c"]:
                    if now is not None:
                        yield end()
                    now = r | {"m": r["m"][:1]}
                    continue
                now["m"] = times(now["m"], r["m"])
                for k in COUNTS:
                    now[k] += r[k]
                now["illegal"] += now["last"] + r["first"] not in LEGAL
                now["last"] = r["last"]
                if r["lo"] is not None:
                    now["turns"] += r["turns"] - (now["hi"] == r["lo"])
                    now["lo"], now["hi"] = r["lo"] if now["lo"] is None else now["lo"], r["hi"]
        if now is not None:
            yield end()

    inner = chunks.where(~F.col("edge")).mapInArrow(whole, f"c {key}, {HEADER}")
    fields = ", ".join(x for x in CHUNK.split(", ") if not x.startswith("word"))
    ends = chunks.where("edge").mapInArrow(part, f"c {key}, {fields}, costs array<bigint>, ropes array<string>")
    ends = ends.repartition("c").sortWithinPartitions("c", "pid").mapInArrow(fold, f"c {key}, {HEADER}")
    return inner.unionByName(ends)


# ------------------------------------------------------------------ replay
class Replay:
    """Streams a conversation's rows through its audit; ``say`` gets the repaired turns."""

    def __init__(self, audit: str, say):
        self.audit, self.at, self.state, self.say = audit, 0, 0, say

    def _next(self, text, edit):
        user = self.state in TO_USER
        self.state = 2 if user else 3
        self.say("user" if user else "assistant", text, edit)

    def inserted(self):
        while self.audit[self.at:self.at + 1] == INSERT:
            self.at += 1
            self._next("", INSERT)

    def row(self, role, text):
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = {"s": 1, "u": 2, "a": 3}[role[:1]]
            self.say(role, text, edit)
        elif edit == REROLE:
            self._next(text, edit)


def _meet(rows: DataFrame, headers: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Rows behind their conversation's header, sorted for one stream per partition."""
    key, n = rows.schema["c"].dataType.simpleString(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    head = headers.withColumn("kind", F.lit(1))
    if ids is not None:
        head = head.unionByName(ids.select(F.col("conv_id").cast(key).alias("c")).distinct().withColumn("kind", F.lit(0)),
                                allowMissingColumns=True)
    both = head.unionByName(rows.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    return both.repartition(n, "c").sortWithinPartitions(*_order("c", "kind")).drop("h", "turn")


def _stream(batches: Iterator[pa.RecordBatch], start, row, end, done: list, names: list[str], types: list):
    """Calls start(id, header or None), row(role, text) and end() in order; what they put into
    ``done`` goes out as batches (the id is the first column)."""
    now, open_, key_type = None, False, None

    def out():
        cols = [pa.array(v, t) for v, t in zip(zip(*done), [key_type, *types])]
        done.clear()
        return pa.RecordBatch.from_arrays(cols, names=names)

    for b in batches:
        key_type = b.schema.field("c").type
        cols = {k: b.column(k).to_pylist() for k in b.schema.names if k not in ("role", "text")}
        roles, texts = b.column("role"), b.column("text")
        for i, (c, kind) in enumerate(zip(cols["c"], cols["kind"])):
            if not open_ or c != now:
                if open_:
                    end()
                now, open_ = c, True
                start(c, None)
            if kind == 1:
                start(c, {k: v[i] for k, v in cols.items()})
            elif kind == 2:
                row(roles[i].as_py(), texts[i].as_py())
            if len(done) >= OUT_ROWS:
                yield out()
    if open_:
        end()
    if done:
        yield out()


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: conv_id, gaps (missing turn numbers), blank, duplicate, truncated,
    illegal (neighbours out of order), cost, audit and repaired_sha256.  ``ids`` (conv_id)
    adds conversations that have no rows."""
    rows, headers = _analyse(turns)
    key = rows.schema["c"].dataType.simpleString()
    fields = [x.split()[0] for x in HEADER.split(", ")]
    zeros = dict.fromkeys(fields, 0) | {"audit": ""}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, conv, head, sha, first, replay = [], None, zeros, None, True, None

        def say(role, text, _):
            nonlocal first
            sha.update(f"{'' if first else NEWLINE}{role}:{text}".encode("utf-8", "surrogatepass"))
            first = False

        def start(c, header):
            nonlocal conv, head, sha, first, replay
            conv, head, first, sha = c, header or zeros, True, hashlib.sha256()
            replay = Replay(head["audit"], say)

        def end():
            replay.inserted()
            done.append((conv, *[head[k] for k in fields], sha.hexdigest()))

        yield from _stream(batches, start, lambda *x: replay.row(*x), end, done,
                           ["conv_id", *fields, "repaired_sha256"], [*[pa.int64()] * 6, pa.string(), pa.string()])

    return _meet(rows, headers, ids).mapInArrow(run, f"conv_id {key}, {HEADER}, repaired_sha256 string")


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, turn (from 0), role, text, edit (K kept,
    R with another role, I inserted)."""
    rows, headers = _analyse(turns)
    key = rows.schema["c"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, conv, at, replay = [], None, 0, None

        def say(role, text, edit):
            nonlocal at
            done.append((conv, at, role, text, edit))
            at += 1

        def start(c, header):
            nonlocal conv, at, replay
            conv, at, replay = c, 0, Replay(header["audit"] if header else "", say)

        yield from _stream(batches, start, lambda *x: replay.row(*x), lambda: replay.inserted(), done,
                           ["conv_id", "turn", "role", "text", "edit"], [pa.int64(), *[pa.string()] * 3])

    return _meet(rows, headers, None).mapInArrow(
        run, f"conv_id {key}, turn bigint, role string, text string, edit string")


def _analyse(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = _rows(turns)
    chunks = _chunks(_runs(rows))
    grammar = learn_grammar(chunks.select("word"))
    return rows, cut_lineage(_audits(chunks, grammar))
