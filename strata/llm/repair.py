"""Token files compressed by Re-Pair grammars.

Documents are dealt to ranges of their id; each range writes shards of about
``SHARD`` tokens.  In a shard the most frequent pairs of symbols are replaced
by nonterminals again and again; a shard stores its rules, the number of
tokens each rule stands for, and the remaining sequence.  The sums of those
numbers lead from a token's position to the symbol that holds it, so any range
of tokens is decoded without the rest.

Shards are rows of Parquet files, so they can lie in any store that Spark
writes to, and a lost task writes its shards again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import text_chunks
from strata.llm.tokens import encoder_of
from strata.session import scratch_path

#: Tokens of a shard, about (a document is never divided).
SHARD = 1 << 20
#: Ids below this are tokens, the others nonterminals.
BASE = 50_257
#: A pair is frequent if it occurs so often; a rule pays if it is used so often.
LEAST, USES = 8, 3
#: Pairs of a round are at most so many times rarer than its most frequent one.
SPREAD = 64

_BUCKETS = 20


def _runs(at: np.ndarray) -> np.ndarray:
    """Of ascending starts, those that don't overlap: every second one from the left of each run of neighbours."""
    run = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
    inside = np.arange(len(at)) - np.repeat(run, np.diff(np.concatenate([run, [len(at)]])))
    return inside % 2 == 0


def compress(tokens: np.ndarray, base: int = BASE, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules as rows of two symbols, tokens each rule stands for, remaining sequence).

    Goes on until no pair occurs ``least`` times.  A round counts pairs exactly and
    replaces those that occur at least 1 / ``SPREAD`` as often as the most frequent
    one.  Counts of old pairs only fall, so a round looks at pairs that were frequent
    in the round before and at those with a new symbol.
    """
    sequence = tokens.astype(np.int64)
    rules, lengths = [], [np.ones(base, dtype=np.int64)]
    size, known = lengths[0], base
    at = np.arange(max(0, len(sequence) - 1))
    while len(at):
        keys = sequence[at] << 32 | sequence[at + 1]
        # Most pairs of a text occur once: those whose bucket is small need no exact count.
        bucket = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BUCKETS)).view(np.int64)
        maybe = np.flatnonzero(np.bincount(bucket, minlength=1 << _BUCKETS)[bucket] >= least)
        at, keys = at[maybe], keys[maybe]
        if not len(at):
            break
        which, pairs = pd.factorize(keys)
        counts = np.bincount(which)
        frequent = np.flatnonzero(counts[which] >= least)
        at, which = at[frequent], which[frequent]
        if not len(at):
            break
        for enough in (max(least, int(counts.max()) // SPREAD), int(counts.max())):
            use = np.flatnonzero(counts[which] >= enough)
            place, pair = at[use], which[use]
            if enough == counts.max():
                one = pair == pair[0]
                place, pair = place[one], pair[one]
            free = np.flatnonzero(_runs(place))
            place, pair = place[free], pair[free]
            used = np.bincount(pair, minlength=len(pairs))
            chosen = np.flatnonzero(used >= USES)
            if len(chosen):
                break
        # One pair alone is used at half of its places at least, so a round always finds a rule.
        number = np.full(len(pairs), -1, dtype=np.int64)
        number[chosen] = known + np.arange(len(chosen))
        new = number[pair]
        ruled = np.flatnonzero(new >= 0)
        place, new = place[ruled], new[ruled]
        made = np.stack([pairs[chosen] >> 32, pairs[chosen] & 0xFFFFFFFF], axis=1)
        rules.append(made)
        size = np.concatenate([size, size[made].sum(axis=1)])
        known += len(chosen)
        sequence[place] = new
        gone = np.zeros(len(sequence), dtype=bool)
        gone[place + 1] = True
        look = np.zeros(len(sequence), dtype=bool)
        look[at] = True
        look[place] = True
        look[np.maximum(place - 1, 0)] = True
        # The symbol before a new one may be gone itself; the new symbol of that place then has the pair.
        look[np.maximum(place - 2, 0)] = True
        left = np.flatnonzero(~gone)
        sequence, look = sequence[left], look[left]
        look[-1] = False
        at = np.flatnonzero(look)
    made = np.concatenate(rules).astype(np.uint32) if rules else np.zeros((0, 2), dtype=np.uint32)
    return made, size[base:], sequence.astype(np.uint32)


def _rule_tokens(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of all rules one after another, where each rule's start, and the end)."""
    symbols, owner = rules.astype(np.int64).reshape(-1), np.repeat(np.arange(len(rules)), 2)
    while len(symbols) and symbols.max() >= base:
        rule = symbols >= base
        width = np.where(rule, 2, 1)
        at = np.cumsum(width) - width
        out = np.empty(int(width.sum()), dtype=np.int64)
        out[at] = symbols
        pair = rules[symbols[rule] - base]
        out[at[rule]], out[at[rule] + 1] = pair[:, 0], pair[:, 1]
        symbols, owner = out, np.repeat(owner, width)
    return symbols, np.searchsorted(owner, np.arange(len(rules) + 1))


def expand(symbols: np.ndarray, rules: np.ndarray, base: int = BASE, lengths: np.ndarray | None = None) -> np.ndarray:
    """The tokens that a sequence of symbols stands for; with the rules' ``lengths`` short rules are expanded once each."""
    if not len(rules):
        return symbols.astype(np.uint32)
    if lengths is None or int(lengths.sum()) > 4 * SHARD:
        # Long rules: all symbols one level deeper at a time, so that memory follows the output.
        out = symbols.astype(np.int64)
        while len(out) and out.max() >= base:
            rule = out >= base
            at = np.cumsum(1 + rule) - 1 - rule
            deeper = np.empty(len(out) + int(rule.sum()), dtype=np.int64)
            deeper[at] = out
            pair = rules[out[rule] - base]
            deeper[at[rule]], deeper[at[rule] + 1] = pair[:, 0], pair[:, 1]
            out = deeper
        return out.astype(np.uint32)
    tokens, start = _rule_tokens(rules, base)
    tokens = np.concatenate([np.arange(base), tokens]).astype(np.uint32)
    start = np.concatenate([np.arange(base), start + base]).astype(np.int32)
    first = start[symbols]
    width = start[symbols.astype(np.int64) + 1] - first
    ends = np.cumsum(width)
    return tokens[np.repeat(first - (ends - width), width) + np.arange(int(ends[-1]) if len(ends) else 0)]


def symbol_lengths(sequence: np.ndarray, lengths: np.ndarray, base: int = BASE) -> np.ndarray:
    """The tokens that each symbol stands for."""
    size = np.ones(len(sequence), dtype=np.int64)
    rule = sequence >= base
    size[rule] = lengths[sequence[rule].astype(np.int64) - base]
    return size


def decode_range(rules: np.ndarray, lengths: np.ndarray, sequence: np.ndarray, a: int, b: int, base: int = BASE) -> np.ndarray:
    """Tokens [a, b) of a shard; only the symbols that hold them are expanded."""
    size = symbol_lengths(sequence, lengths, base)
    ends = np.cumsum(size)
    first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, b, side="left")
    got = expand(sequence[first : last + 1], rules, base, lengths if last - first > len(rules) else None)
    skip = a - int(ends[first] - size[first]) if first < len(ends) else 0
    return got[skip : skip + b - a]


_SHARDS = (
    "part int, shard int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "rules binary, rule_tokens binary, sequence binary"
)


def _write_shards(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        encoder = encoder_of(path, "kept")
        docs, counts, ids, held = [], [], [], 0

        def shard():
            rules, lengths, sequence = compress(np.concatenate(ids))
            row = [
                pa.array([part], pa.int32()),
                pa.array([number], pa.int32()),
                pa.array([held], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([rules.astype("<u4").tobytes()], pa.binary()),
                pa.array([lengths.astype("<u4").tobytes()], pa.binary()),
                pa.array([sequence.astype("<u4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(row, names=[f.split()[0] for f in _SHARDS.split(", ")])

        # The more texts at once, the fewer words are looked up.
        for batch in text_chunks(batches, target=8_000_000):
            got, n = encoder.encode([t or "" for t in batch.column("text").to_pylist()], end)
            names, ends, a = batch.column("doc_id").to_pylist(), np.cumsum(n), 0
            while a < len(n):
                done = int(ends[a] - n[a])
                # The document that fills the shard is its last.
                b = min(len(n), int(np.searchsorted(ends, done + SHARD - held)) + 1)
                docs += names[a:b]
                counts += n[a:b].tolist()
                ids.append(got[done : int(ends[b - 1])])
                held += len(ids[-1])
                if held >= SHARD:
                    yield shard()
                    docs, counts, ids, held, number = [], [], [], 0, number + 1
                a = b
        if docs:
            yield shard()

    return run


def write_token_files(docs: DataFrame, folder: str, path: str, end: int = 0, id: str = "doc_id", text: str = "text") -> None:
    """Token files of all documents in ascending order of the id (null ids first; equal ids by text).

    A document is its text's ids and the id ``end``; null texts are empty and
    repeated rows are written each.  An empty table leaves files without shards.
    """
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    dealt.mapInArrow(_write_shards(path, end), _SHARDS).write.option("compression", "zstd").parquet(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            rules, sequence = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2), np.frombuffer(row["sequence"], dtype="<u4")
            lengths = np.frombuffer(row["rule_tokens"], dtype="<u4").astype(np.int64)
            stands_for = int(symbol_lengths(sequence, lengths).sum())
            if stands_for != row["n_tokens"]:
                raise ValueError(f"shard {row['part']}/{row['shard']} holds {stands_for} tokens, not {row['n_tokens']}")
            tokens = expand(sequence, rules, lengths=lengths).astype("<u4", copy=False)
            n = np.array(row["doc_tokens"], dtype=np.int64)
            ends = np.cumsum(n)
            view = memoryview(tokens.tobytes())
            crc = [zlib.crc32(view[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), n.tolist())]
            size = len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, row["part"]), pa.int32()),
                    pa.array(np.full(size, row["shard"]), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(ends - n, pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
            )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shards = spark.read.parquet(folder)
    sizes = shards.select(F.col("part").alias("_part"), F.col("shard").alias("_shard"), "n_tokens")
    parts = sizes.groupBy("_part").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_part").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, F.col("_part") == F.col("_p"))
    starts = starts.select("_part", "_shard", (F.col("_base") + F.col("_in")).alias("_start"))
    docs = shards.mapInArrow(_read, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    joined = docs.join(starts, (F.col("part") == F.col("_part")) & (F.col("shard") == F.col("_shard")))
    return joined.select("doc_id", (F.col("_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, path: str, end: int = 0) -> DataFrame:
    """Writes the token files below the shared checkpoint folder and reads them back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, folder, path, end)
    return read_token_files(spark, folder)
