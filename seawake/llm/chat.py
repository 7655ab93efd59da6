"""Chat formatting with a grammar round trip.

A conversation is rendered as ``<s>`` and one piece per turn::

    user       [INST] text [/INST]
    system     <<SYS>> text <</SYS>>
    assistant  ␣text </s>
    others     <|percent-coded role|> text <|end|>

A deterministic parser reads pieces back: at a turn border the next characters tell the role, and
the next control string after that must be the role's own closing one. A turn is first rendered
as it is and reparsed; when the recovered turn differs from the source (its text holds a control
string, or one that already looks escaped) the conflicting places are escaped and the turn is
rendered again, until source and recovery are identical. Escaping puts one more backslash behind the first
character of every control string with any number of backslashes there, so it is undone exactly
by taking one away.

Turns are ordered by turn, then role and text. All rows of a conversation pass through one task
in that order, as a stream: neither rendering nor reading back ever holds more than one turn, so
a conversation of any length costs no memory (its digests are sequential by definition).

Edge cases: null text and null role are empty; null turns come first; repeated rows are turns of
their own; rows with a null ``conv_id`` form one conversation of their own; an empty table gives
only what is added to it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seawake.llm.common import BATCH_BYTES, BATCH_ROWS, strings, table

BEGIN = "<s>"
# Opening and closing control strings by role.
TURN = {"user": ("[INST] ", "[/INST]"), "system": ("<<SYS>> ", "<</SYS>>"), "assistant": (" ", "</s>")}
OTHER_OPEN, OTHER_CLOSE = "<|", "<|end|>"
CONFLICT = "</s>[INST] ok [/INST]"

_REST = r"/?INST\]|/?s>|</?SYS>>|\|"
_SITE = re.compile(rf"([\[<])(\\*)({_REST})")
_ESCAPED = re.compile(rf"([\[<])\\(\\*)({_REST})")
_CONTROL = re.compile(rf"[\[<](?:{_REST})")


def escape(text: str) -> str:
    return _SITE.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def piece(role: str, text: str) -> tuple[str, int, int]:
    """One turn as written, with the span of its text; the text is taken as already escaped."""
    head, tail = TURN.get(role) or (f"{OTHER_OPEN}{quote(role, safe='')}|> ", OTHER_CLOSE)
    return f"{head}{text} {tail}", len(head), len(head) + len(text)


class Malformed(ValueError):
    """The text does not follow the grammar."""


def read_turn(s: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """(role, unescaped text, text start, text end, turn end) of the turn at ``at``."""
    for role, (head, tail) in TURN.items():
        if s.startswith(head, at):
            start = at + len(head)
            break
    else:
        end = s.find("|> ", at)
        if not s.startswith(OTHER_OPEN, at) or end < 0:
            raise Malformed("no turn begins here")
        role, tail, start = unquote(s[at + len(OTHER_OPEN):end]), OTHER_CLOSE, end + 3
    m = _CONTROL.search(s, start)
    if m is None or not s.startswith(tail, m.start()) or m.start() == start or s[m.start() - 1] != " ":
        raise Malformed("a turn must end with its own closing string")
    return role, unescape(s[start:m.start() - 1]), start, m.start() - 1, m.start() + len(tail)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The piece of one turn, its text escaped as often as the round trip asks for."""
    body = text
    for _ in range(3):
        out = piece(role, body)
        try:
            got = read_turn(out[0])
            if got[:2] == (role, text) and got[4] == len(out[0]):
                return out
        except Malformed:
            pass
        body = escape(body)
    raise Malformed(f"no reversible form of a {role!r} turn")


FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("position", T.LongType()),
    T.StructField("piece", T.StringType()), T.StructField("piece_start", T.LongType()),
    T.StructField("loss_start", T.LongType()), T.StructField("loss_end", T.LongType())])


def _batches(rows: Iterator[tuple], schema: T.StructType, kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of at most ``BATCH_ROWS`` rows that end with the one that passes ``BATCH_BYTES`` characters."""
    held: list[tuple] = []
    size = 0
    for r in rows:
        held.append(r)
        size += sum(len(v) for v in r if isinstance(v, str))
        if len(held) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(held, schema, kinds)
            held, size = [], 0
    if held:
        yield _batch(held, schema, kinds)


def _batch(rows: list[tuple], schema: T.StructType, kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=schema.names)


def formatted(conversations: DataFrame) -> DataFrame:
    """One row per turn in conversation order: its piece, where the piece begins in the formatted
    conversation (the first piece carries ``<s>``), and its span under the loss mask (assistant text, else null)."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                                F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, position, at = object(), 0, 0
        for b in batches:
            for conv, role, text in zip(b.column(0).to_pylist(), strings(b.column(2)), strings(b.column(3)),
                                        strict=True):
                head = ""
                if conv != now:
                    now, position, at, head = conv, 0, 0, BEGIN
                body, start, end = render(role, text)
                base = at + len(head)
                loss = (base + start, base + end) if role == "assistant" else (None, None)
                yield conv, position, head + body, at, *loss
                position, at = position + 1, base + len(body)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    return ordered.mapInArrow(lambda it: _batches(turns(it), FORMATTED, kinds), FORMATTED)


DIGEST = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])


def read_back(pieces: DataFrame) -> DataFrame:
    """Parse formatted conversations (rows in order, as ``formatted`` yields them) and digest what was recovered."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, state = object(), None
        for b in batches:
            loss_at = b.schema.get_field_index("loss_start")
            for conv, position, text, at, lo, hi in zip(
                    b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                    b.column(3).to_pylist(), b.column(loss_at).to_pylist(), b.column(loss_at + 1).to_pylist(),
                    strict=True):
                if position == 0:
                    if state:
                        yield state.row(now)
                    now, state = conv, _Recovered()
                state.add(text, at, lo, hi)
        if state:
            yield state.row(now)

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pieces.mapInArrow(lambda it: _batches(digests(it), DIGEST, kinds), DIGEST)


class _Recovered:
    """What the parser has recovered of one conversation so far."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, written: str, at: int, lo: int | None, hi: int | None) -> None:
        if at != self.chars:
            raise Malformed("a piece is missing")
        pos = 0
        if at == 0:
            if not written.startswith(BEGIN):
                raise Malformed("a conversation begins with <s>")
            pos = len(BEGIN)
        role, text, _, _, pos = read_turn(written, pos)
        if pos != len(written):
            raise Malformed("text between turns")
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if lo is not None:
            masked = unescape(written[lo - at:hi - at])
            self.loss.update(masked.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(masked)
        self.n_turns += 1
        self.chars += len(written)

    def row(self, conv: int | None) -> tuple:
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"),
                                                         F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONFLICT), (-1, 1, "assistant", CONFLICT)], given.schema)
    return read_back(formatted(given.unionAll(extra)))


_SQL_SITES = r"[\[<]\\*(?:/?INST\]|/?s>|</?SYS>>|\|)"
ORACLE = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{CONFLICT}' UNION ALL SELECT -1, 1, 'assistant', '{CONFLICT}'),
p AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_SQL_SITES}'))
         + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 6
                ELSE length(role) + 13 END AS chars
  FROM c)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id
"""
