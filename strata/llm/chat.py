"""Chat formatting by schema fingerprints.

Records come in many layouts: a prompt and a completion, an instruction with
an input and an output, a list of messages, one row per turn.  A layout
declares where its turns are.  A record's fingerprint is the hash of the field
paths that it fills (``messages[].role``); the fingerprints that a layout can
have are known beforehand, so a fingerprint selects the declarative mapping
that turns the record into canonical (role, text) turns.

The template writes one piece per turn: control strings mark its role and its
end, and control strings and backslashes inside a text get a backslash before
them, which reading back takes off again.  Pieces of a conversation, in order,
are its formatted text; each carries the span of its loss mask.

All of this is column expressions.  Only the digests of whole conversations
are taken in Arrow tasks, over rows that arrive sorted, so a conversation of
any length needs the memory of one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """Where a record's turns are.

    ``fields``: (role, field) in order, a turn each, left out where the field is
    null.  ``messages``: (list, role field, text field).  ``row``: (role field,
    text field, order field), the record itself is a turn; the order is no part
    of the fingerprint.  ``optional`` paths may be null.
    """

    name: str
    fields: tuple[tuple[str, str], ...] = ()
    messages: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        if self.messages:
            at, role, text = self.messages
            return [f"{at}[].{role}", f"{at}[].{text}"]
        return list(self.row[:2]) if self.row else [f for _, f in self.fields]

    def fingerprints(self) -> list[str]:
        needed = [p for p in self.paths() if p not in self.optional]
        return [fingerprint_of([*needed, *more]) for n in range(len(self.optional) + 1) for more in combinations(self.optional, n)]


#: Known layouts; the first whose fingerprints have a record's wins.
LAYOUTS = (
    Layout("turn rows", row=("role", "text", "turn"), optional=("role", "text")),
    Layout("messages", messages=("messages", "role", "content"), optional=("messages[].role", "messages[].content")),
    Layout("from and value", messages=("conversations", "from", "value"), optional=("conversations[].from", "conversations[].value")),
    Layout("instruction", fields=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("system", "input", "output")),
    Layout("prompt and completion", fields=(("system", "system"), ("user", "prompt"), ("assistant", "completion")), optional=("system", "completion")),
    Layout("prompt and response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system", "response")),
    Layout("question and answer", fields=(("user", "question"), ("assistant", "answer")), optional=("answer",)),
)
#: Other names of roles.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint_of(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def field_paths(kind: T.DataType, path: str = "") -> list[tuple[str, Callable[[Column], Column]]]:
    """(path, test that a value fills it) of every leaf of a type; lists add ``[]`` to the path."""
    if isinstance(kind, T.StructType):
        out = []
        for f in kind.fields:
            for p, test in field_paths(f.dataType, f"{path}.{f.name}" if path else f.name):
                out.append((p, lambda c, n=f.name, t=test: t(c.getField(n))))
        return out
    if isinstance(kind, T.ArrayType):
        return [
            (p, lambda c, t=test: F.coalesce(F.exists(c, lambda x: F.coalesce(t(x), F.lit(False))), F.lit(False)))
            for p, test in field_paths(kind.elementType, path + "[]")
        ]
    return [(path, lambda c: c.isNotNull())]


def record_fingerprint(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the paths that a record fills, of those that layouts name (other columns don't count)."""
    known = {p for one in layouts for p in one.paths()}
    filled = []
    for f in df.schema.fields:
        for p, test in field_paths(f.dataType, f.name):
            if p in known:
                filled.append((p, F.when(test(F.col(f"`{f.name}`")), F.lit(p))))
    names = [c for _, c in sorted(filled, key=lambda x: x[0])]
    return F.sha2(F.concat_ws("\n", F.array_compact(F.array(*names)) if names else F.lit("")), 256)


def _role(c: Column) -> Column:
    plain = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    out = F.coalesce(c.cast("string"), F.lit(""))
    for other, role in ROLES.items():
        out = F.when(plain == other, F.lit(role)).otherwise(out)
    return out


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _turns(layout: Layout) -> Column:
    if layout.messages:
        at, role, text = layout.messages
        return F.transform(F.col(at), lambda m: _turn(_role(m.getField(role)), m.getField(text)))
    if layout.row:
        return F.array(_turn(_role(F.col(layout.row[0])), F.col(layout.row[1])))
    return F.filter(
        F.array(*[F.when(F.col(f).isNotNull(), _turn(F.lit(role), F.col(f))) for role, f in layout.fields]), lambda t: t.isNotNull()
    )


def canonical_turns(records: DataFrame, id: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Records -> one row per turn: conv_id, turn, part, role, text, layout.

    ``turn`` is the order field of row layouts (null: null), else 0; ``part``
    the turn's place in its record.  A record whose fingerprint no layout has
    gives one row with null role, text and layout.  Null texts are empty, null
    roles are the empty role; records that repeat stay.
    """
    have = {p for f in records.schema.fields for p, _ in field_paths(f.dataType, f.name)}
    marked = records.withColumn("__print", record_fingerprint(records, layouts))
    whole = {one.name: set(one.paths()) | ({one.row[2]} if one.row else set()) for one in layouts}
    usable = [one for one in layouts if have >= (whole[one.name] if one.row or one.messages else whole[one.name] - set(one.optional))]
    turns, name, order = F.lit(None), F.lit(None), F.lit(None)
    for one in reversed(usable):
        fields = tuple(f for f in one.fields if f[1] in have)
        chosen = F.col("__print").isin(one.fingerprints())
        turns = F.when(chosen, _turns(Layout(one.name, fields, one.messages, one.row))).otherwise(turns)
        name = F.when(chosen, F.lit(one.name)).otherwise(name)
        order = F.when(chosen, F.col(one.row[2]).cast("bigint") if one.row else F.lit(0).cast("bigint")).otherwise(order)
    kind = "array<struct<role:string,text:string>>"
    rows = marked.select(
        F.col(id).cast("bigint").alias("conv_id"), order.cast("bigint").alias("turn"), name.cast("string").alias("layout"), turns.cast(kind).alias("_turns")
    )
    out = rows.select("conv_id", "turn", "layout", F.posexplode_outer("_turns").alias("part", "_t"))
    return out.select("conv_id", "turn", "part", F.col("_t.role").alias("role"), F.col("_t.text").alias("text"), "layout")


#: Control strings of the template, and backslashes.
_CONTROL = r"(\\|</?s>|\[/?(?:INST|SYS|OUT|ROLE)[\] ])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\" + _CONTROL, "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """Turns -> pieces: conv_id, turn, part, piece, loss_start, loss_length (code points, from 0; 0 long: no loss)."""
    role, text = F.coalesce("role", F.lit("")), escape(F.coalesce("text", F.lit("")))
    name = escape(role)
    head = (
        F.when(role == "user", F.lit("<s>[INST]"))
        .when(role == "assistant", F.lit("[OUT]"))
        .when(role == "system", F.lit("[SYS]"))
        .otherwise(F.concat(F.lit("[ROLE "), F.length(name).cast("string"), F.lit("]"), name))
    )
    tail = (
        F.when(role == "user", F.lit("[/INST]")).when(role == "assistant", F.lit("</s>")).when(role == "system", F.lit("[/SYS]")).otherwise(F.lit("[/ROLE]"))
    )
    out = turns.where(F.col("role").isNotNull()).select("conv_id", "turn", "part", head.alias("_head"), text.alias("_text"), tail.alias("_tail"), (role == "assistant").alias("_loss"))
    return out.select(
        "conv_id",
        "turn",
        "part",
        F.concat("_head", "_text", "_tail").alias("piece"),
        F.length("_head").cast("bigint").alias("loss_start"),
        F.when(F.col("_loss"), F.length("_text")).otherwise(F.lit(0)).cast("bigint").alias("loss_length"),
    )


def read_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces -> conv_id, turn, part, role, text, loss_text, formatted_chars, read from the formatted text and its mask."""
    piece = F.col("piece")
    n = F.length(piece)
    named = F.regexp_extract(piece, r"^\[ROLE (\d+)\]", 1)
    mark = F.length(named) + 7
    size = F.coalesce(named.try_cast("int"), F.lit(0))
    role = (
        F.when(piece.startswith("<s>[INST]"), F.lit("user"))
        .when(piece.startswith("[OUT]"), F.lit("assistant"))
        .when(piece.startswith("[SYS]"), F.lit("system"))
        .otherwise(unescape(F.substring(piece, mark + 1, size)))
    )
    head = F.when(piece.startswith("<s>[INST]"), F.lit(9)).when(piece.startswith("[OUT]"), F.lit(5)).when(piece.startswith("[SYS]"), F.lit(5)).otherwise(mark + size)
    tail = F.when(piece.startswith("[OUT]"), F.lit(4)).when(piece.startswith("[SYS]"), F.lit(6)).otherwise(F.lit(7))
    return pieces.select(
        "conv_id",
        "turn",
        "part",
        role.alias("role"),
        unescape(F.substring(piece, head + 1, n - head - tail)).alias("text"),
        unescape(F.substring(piece, (F.col("loss_start") + 1).cast("int"), F.col("loss_length").cast("int"))).alias("loss_text"),
        n.cast("bigint").alias("formatted_chars"),
    )


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _DIGEST.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    rows: list[tuple] = []
    state = None

    def close():
        conv, n, turns, chars, loss, formatted = state
        rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

    for batch in batches:
        for conv, role, text, loss, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "loss_text", "formatted_chars"))):
            if state is None or state[0] != conv:
                if state is not None:
                    close()
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[1] += 1
            state[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            state[3] += len(loss)
            state[4].update(loss.encode("utf-8", "surrogatepass"))
            state[5] += size
        if len(rows) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows.clear()
    if state is not None:
        close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """What the pieces of each conversation say, read back (columns of ``_DIGEST``).

    Turns in order of turn (null first), part, role and text.
    """
    read = read_pieces(pieces).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "part", "role", "text")
    return read.select("conv_id", "role", "text", "loss_text", "formatted_chars").mapInArrow(_digest, _DIGEST)
