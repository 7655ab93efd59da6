"""Conversation structure repair: a grammar-compressed dynamic program.

Every row of a conversation becomes one symbol: its role initial (``s``, ``u``, ``a`` or another) and whether its text is cut
off, or "must go" (blank and repeated rows). A legal conversation has role initials ``(s?(ua)+)?``, an automaton of four
states. The edits (keep, re-role, delete, insert) turn a symbol into a 4 × 4 **min-plus transfer matrix**: entry (p, q) holds
the least cost of going from state p to q over that symbol, and the least audit (letters of the edits) among the cheapest ways.

**Grammar.** Re-Pair names frequent neighbouring symbols by new symbols, over all conversations at once: Spark counts the pairs of the
distinct sequences, weighted by how often each occurs, the most frequent pairs that cannot overlap become rules, and the next round counts
on the sequences so shortened, until no pair repeats or ``MAX_RULES`` is reached (what no rule covers stays spelled out, nothing
is lost). The matrix of a rule is the product of its two sides' matrices, computed bottom-up once and shared by every
conversation; a conversation is then a short product of rule matrices.

**Ropes.** An audit is a rope: a node joins two audits without copying them, and carries length and hash, so two audits are compared by
walking down to their first difference past equal parts. Equal-cost audits over the same rows are never prefixes of each
other (the longer would have more inserts, at more cost), so the least audit of a product is made of least audits.

**Order and hot conversations.** Rows are ordered by turn (nulls first), then role and digest of the text. Equal rows
are counted before they are shuffled. Sequences are cut out of a range partitioning of that order, so a long conversation is spread
over many tasks and reaches the final product as pieces of ``PIECE`` symbols, one byte each. Only the digest of the repaired
conversation, sequential by definition, streams its texts through one task, one row at a time.

Edge cases: null roles, texts and the parts of the damage key are one space; rows with a null ``conv_id`` form one
conversation; a role that is empty, or starts with another letter, can only be re-roled or deleted; a conversation without
rows has zeros, an empty audit and the digest of the empty text; an empty table gives an empty result; other columns of
the table are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import BATCH_ROWS, settle, table

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3           # costs
BLANK = r"\x20\x09-\x0D"
ENDS = ".!?"
LEGAL_PAIRS = ("su", "ua", "au")

CLASSES = "sua"                   # role initials with a place in a legal conversation; any other is class 3
GONE = 8                          # symbol of a row that must be deleted; others are 2 * class + truncated
FIRST_RULE = 9
MAX_RULES = 256
RULES_A_ROUND = 32
PIECE = 4096                      # symbols of one stored piece of a sequence

START, SYSTEM, USER, ASSISTANT = range(4)     # states: the last role so far
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}     # the role that may be re-roled to or inserted
NAMES = {USER: "user", ASSISTANT: "assistant"}
ACCEPTED = (START, ASSISTANT)


# ------------------------------------------------------------------ ropes and matrices

_PRIME, _BASE = (1 << 89) - 1, 0x1F3A5C7B9D2E4F608


class Rope:
    """A text joined from parts; ``hash`` is polynomial, so that equal texts have equal hashes however they were joined."""

    __slots__ = ("hash", "left", "power", "right", "size", "text")

    def __init__(self, text: str = "", left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.hash, self.power = len(text), 0, pow(_BASE, len(text), _PRIME)
            for c in text:
                self.hash = (self.hash * _BASE + ord(c)) % _PRIME
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * right.power + right.hash) % _PRIME
            self.power = left.power * right.power % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return self if self.size else other
        return Rope(left=self, right=other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        a, b = [self], [other]
        while a and b:
            x, y = a.pop(), b.pop()
            if x is y or (x.size == y.size and x.hash == y.hash):
                continue
            if x.left is not None and (y.left is None or x.size >= y.size):
                a += [x.right, x.left]
                b.append(y)
            elif y.left is not None:
                b += [y.right, y.left]
                a.append(x)
            else:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text[:n] < y.text[:n]
                a += [Rope(x.text[n:])] if x.size > n else []
                b += [Rope(y.text[n:])] if y.size > n else []
        return bool(b)


EMPTY = Rope()
Entry = tuple[int, Rope] | None                    # cost and audit of the best way, None where there is none
Matrix = list[list[Entry]]


def better(x: Entry, y: Entry) -> Entry:
    """The cheaper way, of equal ones that with the lesser audit."""
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return y if y[1] < x[1] else x


def times(row: list[Entry], m: Matrix) -> list[Entry]:
    """Min-plus product of a row of entries and a matrix."""
    out: list[Entry] = [None] * 4
    for x, line in zip(row, m, strict=True):
        if x is not None:
            for q, y in enumerate(line):
                if y is not None and (out[q] is None or x[0] + y[0] <= out[q][0]):
                    out[q] = better(out[q], (x[0] + y[0], x[1] + y[1]))
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    return [times(row, b) for row in a]


@cache
def inserts() -> Matrix:
    """Any number of inserted rows."""
    one: Matrix = [[None] * 4 for _ in range(4)]
    out: Matrix = [[(0, EMPTY) if p == q else None for q in range(4)] for p in range(4)]
    for p, q in AFTER.items():
        one[p][q] = (INSERT, Rope("I"))
    for _ in range(3):                              # longer chains only come back to a state at more cost
        out = [[better(x, y) for x, y in zip(r, s, strict=True)] for r, s in zip(out, product(out, one), strict=True)]
    return out


def edited(symbol: int) -> Matrix:
    """One row: inserts before it, then its own edit."""
    m: Matrix = [[(DELETE, Rope("D")) if p == q else None for q in range(4)] for p in range(4)]
    if symbol != GONE:
        kind, cut = symbol // 2, TRUNCATED * (symbol % 2)
        for p, q in AFTER.items():
            m[p][q] = (REROLE + cut, Rope("R"))
            if kind < 3 and CLASSES[kind] == NAMES[q][0]:
                m[p][q] = (KEEP + cut, Rope("K"))
        if kind < 3 and CLASSES[kind] == "s":
            m[START][SYSTEM] = (KEEP + cut, Rope("K"))
    return product(inserts(), m)


@cache
def matrices(rules: tuple[tuple[int, int], ...]) -> list[Matrix]:
    """The transfer matrix of every symbol, rules bottom-up."""
    out = [edited(s) for s in range(FIRST_RULE)]
    for a, b in rules:
        out.append(product(out[a], out[b]))
    return out


# ------------------------------------------------------------------ grammar

def replaced(x: np.ndarray, a: int, b: int, new: int) -> np.ndarray:
    """``x`` with the pair (a, b) replaced from the left."""
    at = np.flatnonzero((x[:-1] == a) & (x[1:] == b))
    if a == b and len(at):                          # in a run, every second place
        first = np.concatenate([[True], np.diff(at) != 1])
        since = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        at = at[since % 2 == 0]
    if not len(at):
        return x
    x = x.copy()
    x[at] = new
    return np.delete(x, at + 1)


def shortened(sequences: list[bytes], rules: tuple[tuple[int, int], ...]) -> list[np.ndarray]:
    """The sequences after all rules, in the order of the rules."""
    if not sequences:
        return []
    x = np.frombuffer(b"\xff".join(sequences), np.uint8).astype(np.int32)
    x[x == 255] = -1
    for k, (a, b) in enumerate(rules):
        x = replaced(x, a, b, FIRST_RULE + k)
    return [s[s >= 0] for s in np.split(x, np.flatnonzero(x == -1))]


PAIRS = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())])


def pair_counts(sequences: DataFrame, rules: tuple[tuple[int, int], ...]) -> DataFrame:
    """(a, b, n): how often symbols follow each other in the shortened sequences (``symbols``, ``weight``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()                   # at most the square of the symbols
        for b in batches:
            short = shortened(b.column(0).to_pylist(), rules)
            for s, w in zip(short, b.column(1).to_pylist(), strict=True):
                if len(s) > 1:
                    pairs, n = np.unique(s[:-1].astype(np.int64) << 32 | s[1:], return_counts=True)
                    for p, k in zip(pairs.tolist(), n.tolist(), strict=True):
                        seen[p] += w * k
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p >> 32 for p in seen], pa.int32()), pa.array([p & 0xFFFFFFFF for p in seen], pa.int32()),
                 pa.array(seen.values(), pa.int64())], names=PAIRS.names)

    return sequences.select("symbols", "weight").mapInArrow(run, PAIRS).groupBy("a", "b").agg(F.sum("n").alias("n"))


def re_pair(sequences: DataFrame, max_rules: int = MAX_RULES) -> tuple[tuple[int, int], ...]:
    """Rules of the grammar; rule k names symbol ``FIRST_RULE + k``.

    Pairs of one round share no border (no rule starts with a symbol another ends with), so the occurrences of one never
    overlap those of another and their counts hold together.
    """
    rules: tuple[tuple[int, int], ...] = ()
    while len(rules) < max_rules:
        frequent = pair_counts(sequences, rules).where("n > 1").orderBy(F.desc("n"), "a", "b").limit(4 * RULES_A_ROUND).collect()
        chosen: list[tuple[int, int]] = []
        for a, b, _ in frequent:
            if len(chosen) < min(RULES_A_ROUND, max_rules - len(rules)) and not any(a == d or b == c for c, d in chosen):
                chosen.append((a, b))
        if not chosen:
            break
        rules += tuple(chosen)
    return rules


# ------------------------------------------------------------------ rows to pieces of sequences

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the prescribed damage."""
    space = F.lit(" ")
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("hit", F.crc32(key) % 20).where("hit != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", f"[{ENDS}]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


ORDER = ("known", "turn", "role", "digest")         # of the rows of a conversation; known: the turn is not null


def marked(rows: DataFrame) -> DataFrame:
    """Different rows of every conversation: how often each occurs (``n``), its faults, and whether it was seen before.

    Grouping comes before any join, and the joined side has one row per text of a conversation, so copies never meet in one task.
    """
    ends = F.regexp_extract("text", rf"([^{BLANK}])[{BLANK}]*\z", 1)
    facts = rows.select("conv_id", F.col("turn").isNotNull().alias("known"), "turn", "role", digest_of(F.col("text")).alias("digest"),
                        (ends == "").alias("blank"), (~ends.isin(*ENDS)).alias("cut"))
    once = facts.groupBy("conv_id", *ORDER).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    first = once.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("known", "turn")).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    joined = once.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")))
    again = ~F.struct("known", "turn").eqNullSafe(F.col("first"))
    return joined.select("conv_id", *ORDER, "n", "blank", "cut", again.alias("again"), F.substring("role", 1, 1).alias("initial"))


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
PIECES = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("known", T.BooleanType()), T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()), T.StructField("digest", T.BinaryType()), T.StructField("part", T.LongType()),
    T.StructField("symbols", T.BinaryType()), *[T.StructField(c, T.LongType()) for c in COUNTS],
    T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()),
    T.StructField("first_turn", T.LongType()), T.StructField("last_turn", T.LongType())])
_KINDS = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def _batched(rows: Iterator[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of at most ``BATCH_ROWS`` rows and some 4 MB of values."""
    held: list[tuple] = []
    size = 0

    def batch() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[f.dataType.simpleString()])
                                           for c, f in zip(columns, schema, strict=True)], names=schema.names)

    for r in rows:
        held.append(r)
        size += sum(len(v) for v in r if isinstance(v, (str, bytes)))
        if len(held) >= BATCH_ROWS or size > 4 << 20:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


class _Piece:
    """Symbols and counts of consecutive rows of one conversation."""

    def __init__(self, key: tuple, part: int):
        self.key, self.part, self.symbols, self.n = key, part, bytearray(), Counter()
        self.first_initial = self.last_initial = self.first_turn = self.last_turn = None

    def add(self, turn: int | None, initial: str, blank: bool, again: bool, cut: bool) -> None:
        symbol = GONE if blank or again else 2 * (CLASSES.find(initial) if initial and initial in CLASSES else 3) + cut
        self.n["blank" if blank else "duplicate" if again else "truncated"] += blank or again or cut
        self.symbols.append(symbol)
        if self.first_initial is None:
            self.first_initial = initial
        else:
            self.n["illegal"] += self.last_initial + initial not in LEGAL_PAIRS
        self.last_initial = initial
        if turn is not None:
            self.n["turns"] += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self) -> tuple:
        return (*self.key, self.part, bytes(self.symbols), *[self.n[c] for c in COUNTS],
                self.first_initial, self.last_initial, self.first_turn, self.last_turn)


def pieces(rows: DataFrame) -> DataFrame:
    """The conversations' symbols in pieces; (known, turn, role, digest, part) order the pieces of a conversation."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        piece, conv = None, object()
        for b in batches:
            for c, known, turn, role, digest, n, blank, ends_badly, again, initial in zip(
                    *[x.to_pylist() for x in b.columns], strict=True):
                part = 0
                for k in range(n):
                    if piece is None or c != conv or len(piece.symbols) == PIECE:
                        if piece is not None:
                            yield piece.row()
                        piece, conv, part = _Piece((c, known, turn, role, digest), part + 1), c, part + 1
                    piece.add(turn, initial, blank, again or k > 0, ends_badly)
        if piece is not None:
            yield piece.row()

    order = ["conv_id", *ORDER]
    ranged = marked(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(lambda it: _batched(cut(it), PIECES), PIECES)


# ------------------------------------------------------------------ solving and applying

SOLVED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("gaps", T.LongType()),
                       *[T.StructField(c, T.LongType()) for c in (*COUNTS[:4], "cost")], T.StructField("audit", T.StringType())])


class _Solution:
    """One conversation's product of matrices so far, with its counts."""

    def __init__(self) -> None:
        self.row: list[Entry] = [(0, EMPTY), None, None, None]
        self.n, self.last_initial = Counter(), None
        self.first_turn = self.last_turn = None

    def add(self, symbols: np.ndarray, known: list[Matrix], counts: dict, initials: tuple, turns: tuple) -> None:
        for s in symbols.tolist():
            self.row = times(self.row, known[s])
        self.n.update(counts)
        if self.last_initial is not None:
            self.n["illegal"] += self.last_initial + initials[0] not in LEGAL_PAIRS
        self.last_initial = initials[1]
        if turns[0] is not None:
            self.n["turns"] -= turns[0] == self.last_turn
            self.first_turn = turns[0] if self.first_turn is None else self.first_turn
            self.last_turn = turns[1]

    def result(self, conv: int | None) -> tuple:
        last = times(self.row, inserts())
        cost, audit = better(last[ACCEPTED[0]], last[ACCEPTED[1]])
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.n["turns"]
        return conv, gaps, *[self.n[c] for c in COUNTS[:4]], cost, str(audit)


def solved(parts: DataFrame, rules: tuple[tuple[int, int], ...]) -> DataFrame:
    """Counts, least cost and audit of every conversation that has pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        known, conv, state = matrices(rules), object(), None
        for b in batches:
            rows = b.to_pylist()
            for r, symbols in zip(rows, shortened([r["symbols"] for r in rows], rules), strict=True):
                if state is None or r["conv_id"] != conv:
                    if state is not None:
                        yield state.result(conv)
                    conv, state = r["conv_id"], _Solution()
                state.add(symbols, known, {c: r[c] for c in COUNTS}, (r["first_initial"], r["last_initial"]),
                          (r["first_turn"], r["last_turn"]))
        if state is not None:
            yield state.result(conv)

    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER, "part")
    return ordered.mapInArrow(lambda it: _batched(run(it), SOLVED), SOLVED)


REPAIRED = T.StructType([*SOLVED.fields, T.StructField("repaired_sha256", T.StringType())])


class _Repair:
    """Applies an audit to rows that come in order, and digests the result."""

    def __init__(self, header: tuple):
        self.header, self.audit, self.at = header, header[-1], 0
        self.state, self.sha, self.any = START, hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.any = True

    def _inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.state = AFTER[self.state]
            self._put(NAMES[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self.state = AFTER[self.state]
            self._put(NAMES[self.state], text)
        elif edit == "K":
            self.state = SYSTEM if role[:1] == "s" else AFTER[self.state]
            self._put(role, text)

    def row(self) -> tuple:
        self._inserted()
        if self.at != len(self.audit):
            raise ValueError("the audit has more edits than the conversation has rows")
        return (*self.header, self.sha.hexdigest())


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``conversations`` (conv_id): counts, cost, audit and digest of its repaired ``rows``."""
    parts = settle(pieces(rows), "sequence-pieces")
    rules = re_pair(settle(parts.groupBy("symbols").agg(F.count("*").alias("weight")), "sequences"))
    known = solved(parts, rules).withColumnsRenamed({"conv_id": "c"})
    all_ = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).groupBy("conv_id").agg(F.count("*").alias("rows"))
    heads = all_.join(known, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in SOLVED.names[1:-1]], F.coalesce("audit", F.lit("")).alias("audit"))
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in SOLVED.fields}
    head = heads.select("conv_id", F.lit(False).alias("known"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.lit(None).cast("binary").alias("digest"), F.lit(True).alias("head"), F.lit(None).cast("string").alias("text"),
                        *SOLVED.names[1:])
    body = rows.select("conv_id", F.col("turn").isNotNull().alias("known"), "turn", "role", digest_of(F.col("text")).alias("digest"),
                       F.lit(False).alias("head"), "text", *[empty[c] for c in SOLVED.names[1:]])
    stream = (head.unionByName(body).repartition("conv_id")
              .sortWithinPartitions("conv_id", F.desc("head"), *ORDER).drop("known", "turn", "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        state = None
        for b in batches:
            for conv, role, head, text, *found in zip(*[x.to_pylist() for x in b.columns], strict=True):
                if head:
                    if state is not None:
                        yield state.row()
                    state = _Repair((conv, *found))
                else:
                    state.add(role, text)
        if state is not None:
            yield state.row()

    return stream.mapInArrow(lambda it: _batched(run(it), REPAIRED), REPAIRED)


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    return repair(damaged(given), given)


# The same by a recursion over rows: states and letters spelled out, CRC-32 bit by bit.
ORACLE = r"""
WITH RECURSIVE
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
hit AS (
  SELECT *, xor(4294967295, list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
             lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END))) % 20 AS h
  FROM given),
r AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit) WHERE h <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM r),
f AS (
  SELECT *, NOT regexp_matches(text, '[^ \x09-\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         regexp_extract(text, '([^ \x09-\x0D])[ \x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
         left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM n),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
         count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS rows
  FROM f GROUP BY conv_id),
ins(p, q, ci, si) AS (VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
                             (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')),
step(p, q, role) AS (VALUES (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a'), (0, 1, 's')),
edit AS (
  SELECT f.conv_id, f.i, s.p, s.q, CASE WHEN f.c = s.role THEN 0 ELSE 3 END + CASE WHEN f.cut THEN 3 ELSE 0 END AS ce,
         CASE WHEN f.c = s.role THEN 'K' ELSE 'R' END AS se
  FROM f, step s WHERE NOT f.blank AND NOT f.again AND (s.role <> 's' OR f.c = 's')
  UNION ALL
  SELECT f.conv_id, f.i, p, p, 4, 'D' FROM f, (SELECT unnest([0, 1, 2, 3]) AS p)),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, q, ci AS cost, si AS audit FROM counts, ins WHERE p = 0
  UNION ALL
  SELECT conv_id, i, q, cost, audit FROM (
    SELECT dp.conv_id, edit.i, ins.q, dp.cost + ce + ci AS cost, dp.audit || se || si AS audit
    FROM dp JOIN edit ON edit.conv_id IS NOT DISTINCT FROM dp.conv_id AND edit.i = dp.i + 1 AND edit.p = dp.q
         JOIN ins ON ins.p = edit.q)
  QUALIFY row_number() OVER (PARTITION BY conv_id, i, q ORDER BY cost, audit) = 1),
best AS (
  SELECT dp.conv_id, dp.cost, dp.audit FROM dp JOIN counts ON counts.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = counts.rows
  WHERE q IN (0, 3) QUALIFY row_number() OVER (PARTITION BY dp.conv_id ORDER BY cost, audit) = 1),
letters AS (
  SELECT conv_id, audit, unnest(generate_series(1, length(audit))) AS j FROM best),
placed AS (
  SELECT conv_id, j, substr(audit, j, 1) AS e, length(replace(left(audit, j), 'I', '')) AS i,
         length(replace(left(audit, j), 'D', '')) AS place FROM letters),
made AS (
  SELECT placed.conv_id, j, place, e, f.role, CASE WHEN e = 'I' THEN '' ELSE f.text END AS text,
         max(CASE WHEN e = 'K' AND place = 1 AND f.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY placed.conv_id) AS sys
  FROM placed LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM placed.conv_id AND f.i = placed.i WHERE e <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (place - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || text, chr(10) ORDER BY j) AS body
  FROM made GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM a.conv_id
"""
