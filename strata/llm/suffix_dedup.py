"""Removal of byte passages that start more than once anywhere in the corpus.

A window is a substring of ``LENGTH`` bytes; every byte under a window that
also starts elsewhere goes.

1. Every window is given to its minimizer (the leftmost 16-gram of least hash),
   so equal windows have the same minimizer at the same offset.  The windows of
   a minimizer are cut by offset into chunks; all windows of a chunk contain
   its core.  Chunks whose core occurs once hold no repeat; where all chunks
   with a core are the same bytes, all of their windows are repeats.  Both are
   settled by one partial aggregate of hashes.
2. The rest, chunks with one core and different bytes around it, are strings
   of those bytes with the core as one symbol.  Their suffixes are what a
   suffix array is needed for: a task sorts shards of strings, takes the
   Burrows-Wheeler transform of each shard, and merges the transforms by
   iterative interleave refinement.  Each round stably moves the interleave by
   the transforms' symbols and so orders it by one symbol more; the round in
   which a boundary appears is the common prefix there.  Intervals whose
   common prefix is a whole window are the repeats.  Symbols are q-grams, and
   rows step by q, so a window takes few rounds.
3. A core with very many different surroundings is dealt out again with a
   longer core and fewer windows a chunk, down to single windows, whose
   strings are all equal; so no group is too large for a task.

Matches never cross texts.  Only hashes and the strings of step 2 are
shuffled; texts are dealt once, and once more where something is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SubstringHash, mix64, ranges, sliding_min, text_chunks
from strata.session import cut_lineage

#: Bytes of a window and of a minimizer, and windows of a chunk.
LENGTH, GRAM, CHUNK = 400, 16, 128
#: Windows of a chunk when a core has more than ``HOT`` different surroundings, and when that is not enough.
NARROWER = (16, 1)
HOT = 4096
#: Strings that a task merges at once, about, and shards they are cut into.
STRINGS, SHARDS = 4096, 4
#: Text bytes that are hashed at once.
BLOCK = 1 << 22


def _blocks(texts: list[bytes], length: int):
    """(bytes, number of text, offset in it, start and end in the bytes) arrays that cover each window once."""
    held, size = [], 0
    for k, t in enumerate(texts):
        if len(t) < length:
            continue
        for a in range(0, len(t) - length + 1, BLOCK):
            piece = t[a : a + BLOCK + length - 1]
            held.append((k, a, piece))
            size += len(piece)
            if size >= BLOCK:
                yield held
                held, size = [], 0
    if held:
        yield held


def chunks_of(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text number, start, windows, core start, key, piece hash) of all chunks of the texts."""
    out: list[tuple] = []
    for held in _blocks(texts, length):
        b = np.frombuffer(b"".join(p for _, _, p in held), dtype=np.uint8)
        sizes = np.array([len(p) for _, _, p in held])
        ends = np.cumsum(sizes)
        sums = SubstringHash(b)
        bits = np.uint64(24)
        grams = sums.windows(GRAM)
        packed = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(packed, length - GRAM + 1)
        # Windows that lie inside one text.
        count = sizes - length + 1
        at = np.repeat(ends - sizes, count) + ranges(count)
        which = np.repeat(np.arange(len(held)), count)
        anchor = (least[at] & np.uint64((1 << 24) - 1)).astype(np.int64)
        part = (anchor - at) // CHUNK
        new = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(part) != 0) | (np.diff(which) != 0)])
        first = np.flatnonzero(new)
        n = np.diff(np.concatenate([first, [len(at)]]))
        start, part, which = at[first], part[first], which[first]
        core = anchor[first] - part * CHUNK
        core_length = length - CHUNK + 1
        key = mix64(sums.spans(core, core + core_length) + part.astype(np.uint64))
        piece = mix64(sums.spans(start, start + n - 1 + length) ^ (core - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        number = np.array([k for k, _, _ in held])[which]
        shift = (np.array([a for _, a, _ in held]) - (ends - sizes))[which]
        out.append((number, start + shift, n, core + shift, key.view(np.int64), piece.view(np.int64)))
    if not out:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    return tuple(np.concatenate(c) for c in zip(*out))


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]


_CHUNKS = "key long, piece long, doc_id long, text_hash long, place long"


def _chunk_rows(length: int):
    """``place``: the start and, in the low byte, the windows less one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, target=BLOCK):
            number, start, n, _, key, piece = chunks_of(_encoded(batch), length)
            rows = pa.array(number)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key, pa.int64()),
                    pa.array(piece, pa.int64()),
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    pa.array(start * 256 + n - 1, pa.int64()),
                ],
                names=["key", "piece", "doc_id", "text_hash", "place"],
            )

    return run


_OPEN = "doc_id long, text_hash long, start long, core binary, lead binary, tail binary"


def _open_rows(length: int):
    """Chunks that need step 2: the core's digest and the bytes before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = length - CHUNK + 1
        for batch in text_chunks(batches, target=BLOCK):
            texts = _encoded(batch)
            wanted = [{c["place"] for c in row if c["mixed"]} for row in batch.column("chunks").to_pylist()]
            number, start, n, core, _, _ = chunks_of(texts, length)
            rows, out = [], []
            for k, s, w, c in zip(number.tolist(), start.tolist(), n.tolist(), core.tolist()):
                if s * 256 + w - 1 in wanted[k]:
                    t = texts[k]
                    rows.append(k)
                    out.append((s, hashlib.blake2b(t[c : c + size], digest_size=16).digest(), t[s:c], t[c + size : s + w - 1 + length]))
            rows = pa.array(rows, pa.int64())
            columns = zip(*out) if out else [()] * 4
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "text_hash", "start", "core", "lead", "tail"],
            )

    return run


class Strings:
    """Strings of symbols with, at every position, the q-gram there; rows step by q."""

    def __init__(self, strings: list[np.ndarray], q: int):
        sizes = np.array([len(s) for s in strings], dtype=np.int64)
        self.q, self.sizes = q, sizes
        padded = np.zeros(int((sizes + q).sum()), dtype=np.int64)
        at = np.cumsum(sizes + q) - (sizes + q)
        inside = ranges(sizes)
        places = np.repeat(at, sizes) + inside
        padded[places] = np.concatenate(strings)
        grams = SubstringHash(padded, mix64(padded.astype(np.uint64) + np.uint64(0xA0761D6478BD642F))).spans(places, places + q)
        _, symbol = np.unique(grams, return_inverse=True)
        self.symbol = symbol.astype(np.int64)
        self.string = np.repeat(np.arange(len(strings)), sizes)
        self.inside = inside
        self.first = np.cumsum(sizes) - sizes

    def transform(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard of strings a..b-1: positions in suffix order and the symbols before them (-1: none).

        The suffixes that are an end only come first, one for every string and
        phase; their position is -1.
        """
        lo, hi = int(self.first[a]), int(self.first[b - 1] + self.sizes[b - 1])
        n, q = hi - lo, self.q
        symbol, inside = self.symbol[lo:hi], self.inside[lo:hi]
        left = self.sizes[self.string[lo:hi]] - inside
        rank, step = symbol + 1, q
        while step < int(self.sizes[a:b].max(initial=0)):
            follow = np.zeros(n, dtype=np.int64)
            has = left > step
            follow[has] = rank[np.flatnonzero(has) + step]
            _, rank = np.unique(rank * (n + len(self.symbol) + 2) + follow, return_inverse=True)
            rank = rank + 1
            step *= 2
        order = np.argsort(rank, kind="stable")
        before = np.full(n, -1, dtype=np.int64)
        has = np.flatnonzero(inside >= q)
        before[has] = symbol[has - q]
        # Ends in the order of string and phase: the last position of each phase.
        last = np.flatnonzero(left <= q)
        last = last[np.lexsort((inside[last] % q, self.string[lo:hi][last]))]
        return np.concatenate([np.full(len(last), -1), order + lo]), np.concatenate([symbol[last], before[order]])


def merge_transforms(strings: Strings, shards: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merges the transforms of shards; returns the merged suffix order and the common prefix with the row before.

    Both in q-grams, as far as ``rounds``; rows of ends are left out.
    """
    total = len(strings.sizes)
    cuts = np.linspace(0, total, min(shards, total) + 1).astype(int)
    parts = [strings.transform(a, b) for a, b in zip(cuts, cuts[1:])]
    shard = np.repeat(np.arange(len(parts), dtype=np.uint8), [len(p) for p, _ in parts])
    position, before = np.concatenate([p for p, _ in parts]), np.concatenate([s for _, s in parts])
    ends = np.flatnonzero(position < 0)
    interleave = shard.copy()
    fixed = shard[ends]
    n = len(shard)
    block = np.zeros(n, dtype=np.int64)
    common = np.full(n, rounds, dtype=np.int64)
    boundary = np.zeros(n, dtype=bool)
    row = np.arange(n)
    for r in range(rounds + 1):
        # Rows of a shard are consumed in its own order: the k-th row of shard s in the interleave is its k-th row.
        row = np.empty(n, dtype=np.int64)
        row[np.argsort(interleave, kind="stable")] = np.arange(n)
        if r == rounds:
            break
        symbol = before[row]
        moved = np.flatnonzero(symbol >= 0)
        moved = moved[np.argsort(symbol[moved], kind="stable")]
        edge = np.ones(n, dtype=bool)
        s, b = symbol[moved], block[moved]
        edge[len(fixed) + 1 :] = (s[1:] != s[:-1]) | (b[1:] != b[:-1])
        common[edge & ~boundary] = r
        boundary |= edge
        interleave = np.concatenate([fixed, interleave[moved]])
        block = np.cumsum(boundary)
    return position[row][len(fixed) :], common[len(fixed) :]


def repeated_windows(groups: np.ndarray, leads: list[bytes], tails: list[bytes], counts: np.ndarray, extra: int) -> list[np.ndarray]:
    """For strings lead + core + tail (``groups``: number of the core), which of their windows occur more than once.

    A window is the core and ``extra`` bytes around it; ``counts``: occurrences of each string.
    """
    strings = [
        np.concatenate([np.frombuffer(a, np.uint8).astype(np.int64) + 1, [257 + g], np.frombuffer(z, np.uint8).astype(np.int64) + 1])
        for g, a, z in zip(groups.tolist(), leads, tails)
    ]
    q = max(1, (extra + 1) // 8)
    rounds = (extra + 1) // q
    data = Strings(strings, q)
    position, common = merge_transforms(data, SHARDS, rounds)
    interval = np.cumsum(common < rounds) - 1
    weight = np.bincount(interval, weights=counts[data.string[position]])
    repeated = np.zeros(len(data.symbol), dtype=bool)
    repeated[position] = weight[interval] > 1
    return [repeated[f : f + n - extra] for f, n in zip(data.first.tolist(), data.sizes.tolist())]


_MARKED = "piece binary, marks binary"


def _mark(extra: int):
    """Sorted (core, piece, lead, tail, n) rows -> the repeated windows of each piece, as bytes 0/1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def settle(rows: list[tuple]) -> pa.RecordBatch:
            cores = {c: i for i, c in enumerate(dict.fromkeys(r[0] for r in rows))}
            groups = np.array([cores[r[0]] for r in rows])
            marks = repeated_windows(groups, [r[2] for r in rows], [r[3] for r in rows], np.array([r[4] for r in rows]), extra)
            out = [(r[1], m.astype(np.uint8).tobytes()) for r, m in zip(rows, marks) if m.any()]
            columns = zip(*out) if out else [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], names=["piece", "marks"])

        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if len(held) >= STRINGS and held[-1][0] != r[0]:
                    yield settle(held)
                    held = []
                held.append(r)
        if held:
            yield settle(held)

    return run


def _narrow(extra: int, width: int):
    """Rows with shorter chunks: the core takes in the bytes that their windows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for k, (start, core, lead, tail) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("start", "core", "lead", "tail")))):
                n = len(lead) + len(tail) - extra + 1
                # Windows by the bytes of lead they have, x, from len(lead) down.
                for x0 in range(0, extra + 1, width):
                    j0, j1 = max(0, len(lead) - (x0 + width - 1)), min(n - 1, len(lead) - x0)
                    if j0 > j1:
                        continue
                    shared = extra - (x0 + width - 1)  # bytes of tail that all of them have
                    inner_lead, inner_tail = lead[len(lead) - x0 :], tail[: max(shared, 0)]
                    digest = hashlib.blake2b(core + x0.to_bytes(2, "big") + inner_lead + b"\0" + inner_tail, digest_size=16).digest()
                    rows.append(k)
                    out.append((start + j0, digest, lead[j0 : len(lead) - x0], tail[max(shared, 0) : extra - len(lead) + j1]))
            rows = pa.array(rows, pa.int64())
            columns = zip(*out) if out else [()] * 4
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["doc_id", "text_hash", "start", "core", "lead", "tail"],
            )

    return run


def _spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text_hash, start, marks) -> runs of removed bytes."""
        for batch in batches:
            rows, low, high = [], [], []
            for k, (start, marks) in enumerate(zip(batch.column("start").to_pylist(), batch.column("marks").to_pylist())):
                m = np.concatenate([[0], np.frombuffer(marks, np.uint8), [0]]).astype(np.int8)
                edge = np.flatnonzero(np.diff(m))
                for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                    rows.append(k)
                    low.append(start + a)
                    high.append(start + b - 1 + length)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(low, pa.int64()), pa.array(high, pa.int64())],
                names=["doc_id", "text_hash", "low", "high"],
            )

    return run


def open_spans(open_rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Step 2 and 3 on rows of ``_OPEN``: doc_id, text_hash, low, high of repeated runs."""
    found = None
    rows, widths = open_rows, (CHUNK, *NARROWER)
    for width, narrower in zip(widths, (*NARROWER, None)):
        extra = width - 1
        named = rows.withColumn("piece", F.unhex(F.md5(F.concat("core", F.lit(b"\0"), F.length("lead").cast("string").cast("binary"), F.lit(b"\0"), "lead", "tail"))))
        pieces = named.groupBy("core", "piece").agg(F.min("lead").alias("lead"), F.min("tail").alias("tail"), F.count("*").alias("n"))
        if narrower is not None:
            size = pieces.groupBy("core").agg(F.count("*").alias("_pieces")).where(F.col("_pieces") > HOT).select(F.col("core").alias("_hot"))
            hot = cut_lineage(size, "repeat-hot")
            pieces = pieces.join(hot, F.col("core") == F.col("_hot"), "left_anti")
            rest = named.join(hot, F.col("core") == F.col("_hot"), "left_semi").drop("piece")
        dealt = pieces.repartition("core").sortWithinPartitions("core", "piece").select("core", "piece", "lead", "tail", "n")
        marked = dealt.mapInArrow(_mark(extra), _MARKED).withColumnRenamed("piece", "_piece")
        here = named.join(marked, F.col("piece") == F.col("_piece")).select("doc_id", "text_hash", "start", "marks")
        spans = here.mapInArrow(_spans(length), "doc_id long, text_hash long, low long, high long")
        found = spans if found is None else found.unionByName(spans)
        if narrower is None or hot.isEmpty():
            break
        rows = cut_lineage(rest.mapInArrow(_narrow(extra, narrower), _OPEN), "repeat-narrow")
    return found


_CUT = "doc_id long, text_hash long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, target=BLOCK):
            out = []
            for t, chunks, spans in zip(_encoded(batch), batch.column("chunks").to_pylist(), batch.column("spans").to_pylist()):
                runs = [(c["place"] >> 8, (c["place"] >> 8) + (c["place"] & 255) + length) for c in chunks if not c["mixed"]]
                runs = sorted({*runs, *((s["low"], s["high"]) for s in spans or [])})
                kept, at, removed, n, end = [], 0, 0, 0, -1
                for low, high in runs:
                    if low > end:  # a new run; runs that touch are one
                        n += 1
                    kept.append(t[at : max(at, low)])
                    removed += max(0, high - max(low, at))
                    at = max(at, high)
                    end = max(end, high)
                kept.append(t[at:])
                whole = b"".join(kept)
                out.append((removed, n, hashlib.sha256(whole).hexdigest(), whole))
            columns = zip(*out) if out else [()] * 4
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=[f.split()[0] for f in _CUT.split(", ")],
            )

    return run


def removed_texts(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, text_hash, n_removed, n_spans, kept_sha256, kept) of texts that lose bytes, a row for each different (id, text)."""
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    chunks = rows.mapInArrow(_chunk_rows(length), _CHUNKS)
    known = chunks.groupBy("key").agg(F.count("*").alias("c"), F.min("piece").alias("lo"), F.max("piece").alias("hi")).where("c > 1")
    known = known.select(F.col("key").alias("_key"), (F.col("lo") != F.col("hi")).alias("mixed"))
    candidates = chunks.select("key", "doc_id", "text_hash", "place").join(known, F.col("key") == F.col("_key"))
    per_text = candidates.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.collect_list(F.struct("place", "mixed")).alias("chunks"))
    found = rows.join(per_text, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h"))).select("doc_id", "text_hash", "text", "chunks")
    found = cut_lineage(found, "repeat-texts")
    open_rows = cut_lineage(found.where(F.exists("chunks", lambda c: c["mixed"])).mapInArrow(_open_rows(length), _OPEN), "repeat-open")
    spans = open_spans(open_rows, length)
    spans = spans.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h")).agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = found.join(spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    # Not even candidates that are all open and unmatched lose anything: no runs, nothing removed.
    cut = joined.select("doc_id", "text_hash", "text", "chunks", "spans").mapInArrow(_cut(length), _CUT)
    return cut.where("n_removed > 0").dropDuplicates(["doc_id", "text_hash"])


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes (null: empty; under ``length`` bytes: nothing to
    remove).  Repeats are judged on the input: of equal texts all lose
    everything.  Rows that repeat (id and text) are occurrences of their own.
    An empty table gives no rows; other columns are not read.
    """
    base = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    base = base.select("doc_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.encode("text", "UTF-8"), 256).alias("_sha"))
    cut = removed_texts(docs, id, text, length).drop("kept").withColumnsRenamed({"doc_id": "_d", "text_hash": "_h"})
    out = base.join(cut, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    return out.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"),
    )


def brute_force(texts: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) by counting every window, for tests."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            w = hashlib.blake2b(t[i : i + length], digest_size=16).digest()
            seen[w] = seen.get(w, 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, dtype=np.int64)
        for i in range(len(t) - length + 1):
            if seen[hashlib.blake2b(t[i : i + length], digest_size=16).digest()] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone)[: len(t)] > 0
        kept = np.frombuffer(t, np.uint8)[~mask].tobytes()
        spans = int((np.diff(np.concatenate([[0], mask.astype(np.int8)])) == 1).sum())
        out.append((len(t), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out
