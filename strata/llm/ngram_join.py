"""Similarity join on word shingles: MinHash LSH forest and exact verification.

1. Every text becomes its set of five-word shingles; texts with equal sets are
   one class of copies and go on as one.
2. The forest: each of ``TREES`` trees labels a set with ``DEPTH`` MinHash
   values.  A tree is the sorted list of its labels, a prefix trie; sets that
   share a prefix are neighbours in it.  Matching starts at whole labels and
   shortens the prefix until the forest finds a pair at the threshold with the
   target recall.
3. Neighbours under a prefix are streamed in sorted order past leaders (sets
   that no earlier leader resembles); each set is linked to the leaders that
   its signature resembles.  That bounds rows and memory where thousands of
   near copies share a prefix, and no pair is lost: two similar sets resemble
   a common leader.
4. Connected candidates are verified exactly, in blocks of ``BLOCK`` sets
   ordered by size: a task compares two blocks and returns counts of links and
   a spanning forest, not pairs.  Blocks whose sizes exclude the threshold
   are not compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SubstringHash, mix64, text_chunks
from strata.llm.components import connected_components
from strata.session import cut_lineage

#: Words of a shingle and least Jaccard similarity of a link.
WORDS, THRESHOLD = 5, 0.8
#: Trees of the forest, MinHash values of a label, and recall wanted of a pair at the threshold.
TREES, DEPTH, RECALL = 16, 5, 0.999
#: Signature shares from which a set follows a leader, and is linked to it.
FOLLOW, RESEMBLE = 0.65, 0.25
#: Candidate sets whose keys (40 bytes each) are broadcast at most; more are joined by a shuffle of the texts.
SENT = 2_000_000
#: Sets in a block of the verification.
BLOCK = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SEEDS = np.random.default_rng(97).integers(1, 2**63, (2, TREES * DEPTH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(89).integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles (ASCII lower case, words cut at ASCII white space).

    A text of fewer words is one shingle; a text without words has none.
    """
    b = _LOWER[np.frombuffer(b" " + raw + b" ", dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(_SPACE[b].astype(np.int8)))
    start, end = edge[::2] + 1, edge[1::2] + 1
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    w = SubstringHash(b).spans(start, end)
    n = max(1, len(w) - words + 1)
    out = np.full(n, min(len(w), words), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(words, len(w))):
            out = mix64(out + w[i : i + n] * _MIX[i])
    return np.unique(out)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (16 bits each) of non-empty sets, a row a set."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), TREES * DEPTH), dtype=np.uint16)
    with np.errstate(over="ignore"):
        for k in range(TREES * DEPTH):
            least = np.minimum.reduceat(flat * _SEEDS[0, k] + _SEEDS[1, k], starts)
            out[:, k] = mix64(least) >> np.uint64(48)
    return out


def prefix_depth(trees: int = TREES, depth: int = DEPTH, threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix with which the forest finds a pair at the threshold with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


_SETS = "doc_id long, text_hash long, set_key binary, n long, signature binary"


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches, target=2_000_000):
        sets = [shingles((t or "").encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        marks: list[bytes] = [b""] * len(sets)
        if full:
            for i, row in zip(full, signatures([sets[i] for i in full])):
                marks[i] = row.astype("<u2").tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(marks, pa.binary()),
            ],
            names=["doc_id", "text_hash", "set_key", "n", "signature"],
        )


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per tree: tree, label (big-endian, so that byte order sorts the trie), set_key."""
    for batch in batches:
        keys = batch.column("set_key").to_pylist()
        if not keys:
            continue
        sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype="<u2").reshape(len(keys), TREES, DEPTH)
        labels = sig.astype(">u2").tobytes()
        width = 2 * DEPTH
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(keys)), pa.int32()),
                pa.array([labels[i : i + width] for i in range(0, len(labels), width)], pa.binary()),
                pa.array([k for k in keys for _ in range(TREES)], pa.binary()),
            ],
            names=["tree", "label", "set_key"],
        )


def _shared(width: int):
    """Of sorted (tree, label, set_key) rows, those that share their prefix with another; adds the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, alone = None, True

        for batch in batches:
            out = []
            for tree, label, key in zip(*(batch.column(i).to_pylist() for i in range(3))):
                row = (tree, label[:width], key)
                if held is not None and held[:2] == row[:2]:
                    if alone:
                        out.append(held)
                    out.append(row)
                    alone = False
                else:
                    alone = True
                held = row
            columns = zip(*out) if out else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.binary(), pa.binary()])], names=["tree", "prefix", "set_key"]
            )

    return run


def _link_to_leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (tree, prefix, set_key, signature) rows -> candidate edges (a, b) to the prefix's leaders.

    Leaders already connected under this prefix get one edge, so there are
    fewer than two edges a set.
    """
    at, keys, n = None, [], 0
    parent: list[int] = []

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    marks = np.zeros((16, TREES * DEPTH), dtype=np.uint16)
    for batch in batches:
        a, b = [], []
        for tree, prefix, key, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
            sig = np.frombuffer(raw, dtype="<u2")
            if at != (tree, prefix):
                at, keys, n, parent = (tree, prefix), [], 0, []
            share = (marks[:n] == sig).mean(axis=1) if n else np.zeros(0)
            near = sorted({top(i) for i in np.flatnonzero(share >= RESEMBLE).tolist()})
            for i in near:
                a.append(key)
                b.append(keys[i])
                parent[i] = near[0]
            if not n or share.max() < FOLLOW:
                parent.append(near[0] if near else n)
                if n == len(marks):
                    marks = np.concatenate([marks, np.zeros_like(marks)])
                marks[n] = sig
                keys.append(key)
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches, target=2_000_000):
        sets = [shingles((t or "").encode("utf-8", "surrogatepass")).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("set_key"), pa.array(sets, pa.binary())], names=["set_key", "shingles"])


def links_within(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with a Jaccard similarity of ``threshold`` or more: left with right, or left with itself (i < j)."""
    sets = left if right is None else left + right
    m = len(left)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    column = np.cumsum(np.concatenate([[0], np.diff(column) > 0])) if len(column) else column
    common = np.zeros((m, len(sets) - m if right is not None else m), dtype=np.float64)
    width = 4096
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [c, c + width])
        grid = np.zeros((len(sets), width), dtype=np.float32)
        grid[row[a:b], column[a:b] - c] = 1
        common += grid[:m] @ (grid[:m] if right is None else grid[m:]).T
    other = sizes[:m] if right is None else sizes[m:]
    union = sizes[:m, None] + other[None, :] - common
    # common / union >= threshold, without the rounding of a division.
    linked = common >= threshold * union - 1e-9
    if right is None:
        linked = np.triu(linked, 1)
    return np.nonzero(linked)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect."""
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[q] = p
            out.append((x, y))
    return out


_FOUND = "a binary, b binary, n long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (component, i, j, block, set_key, shingles) rows -> (set, null, links) and (set, set, null) rows."""
    at, keys, sets, blocks = None, [], [], []
    out: list[tuple] = []

    def close():
        if len(keys) < 2:
            return
        same = at[1] == at[2]
        left = [s for s, b in zip(sets, blocks) if b == at[1]]
        right = None if same else [s for s, b in zip(sets, blocks) if b == at[2]]
        if right == [] or not left:
            return
        i, j = links_within(left, right)
        if right is not None:
            j = j + len(left)
        order = [k for k, b in zip(keys, blocks) if b == at[1]] + ([] if same else [k for k, b in zip(keys, blocks) if b == at[2]])
        n = np.bincount(np.concatenate([i, j]), minlength=len(order))
        out.extend((order[k], None, int(n[k])) for k in np.flatnonzero(n))
        out.extend((order[x], order[y], None) for x, y in _forest(len(order), i, j))

    def batch_of():
        columns = zip(*out) if out else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.binary(), pa.int64()])], names=["a", "b", "n"])

    for batch in batches:
        for component, i, j, block, key, raw in zip(*(batch.column(c).to_pylist() for c in range(6))):
            if at != (component, i, j):
                close()
                at, keys, sets, blocks = (component, i, j), [], [], []
            keys.append(key)
            sets.append(np.frombuffer(raw, dtype=np.uint64))
            blocks.append(block)
        if len(out) > 10_000:
            yield batch_of()
            out.clear()
    close()
    yield batch_of()


def describe(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Shingle set of every row, written once: doc_id, text_hash, set_key, n, signature."""
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), F.col(text).alias("text")
    )
    return cut_lineage(rows.mapInArrow(_describe, _SETS), "shingle-sets")


def candidate_edges(sets: DataFrame) -> DataFrame:
    """Distinct sets (set_key, signature) -> edges (a, b) that connect every pair the forest finds."""
    width = 2 * prefix_depth()
    labels = sets.mapInArrow(_labels, "tree int, label binary, set_key binary")
    dealt = labels.repartition("tree", F.substring("label", 1, width)).sortWithinPartitions("tree", "label")
    shared = dealt.mapInArrow(_shared(width), "tree int, prefix binary, set_key binary")
    marked = shared.join(sets.select("set_key", "signature"), "set_key").select("tree", "prefix", "set_key", "signature")
    ordered = marked.repartition("tree", "prefix").sortWithinPartitions("tree", "prefix", "set_key")
    return ordered.mapInArrow(_link_to_leaders, "a binary, b binary")


def verified(docs: DataFrame, rows: DataFrame, sets: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Exact links among connected candidates, as rows of ``_FOUND`` (see ``_verify``)."""
    component = connected_components(candidate_edges(sets))
    members = sets.join(component.withColumnRenamed("node", "set_key"), "set_key").select("set_key", "component", "n", "first")
    place = F.row_number().over(Window.partitionBy("component").orderBy("n", "set_key")) - 1
    members = cut_lineage(members.withColumn("block", F.floor(place / BLOCK).cast("int")), "near-members")
    blocks = members.groupBy("component", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    i, j = blocks.alias("i"), blocks.alias("j")
    # Sets are ordered by size: only blocks whose sizes allow the threshold meet.
    meet = (F.col("i.component") == F.col("j.component")) & (F.col("i.block") <= F.col("j.block")) & (F.col("i.high") >= F.col("j.low") * (THRESHOLD - 1e-9))
    tasks = i.join(j, meet).select(F.col("i.component").alias("component"), F.col("i.block").alias("i"), F.col("j.block").alias("j"))
    sides = F.explode(F.array_distinct(F.array("i", "j"))).alias("block")
    tasks = tasks.select("component", "i", "j", sides)
    wanted = members.select("set_key", F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"))
    texts = docs.select(F.col(id).cast("bigint").alias("_d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_h"), F.col(text).alias("text"))
    # Texts pass a shuffle only if there are too many candidates to send their keys to every task.
    if members.count() <= SENT:
        wanted = F.broadcast(wanted)
    found = texts.join(wanted, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")))
    content = found.select("set_key", "text").mapInArrow(_shingle_rows, "set_key binary, shingles binary").dropDuplicates(["set_key"])
    content = cut_lineage(content, "near-content")
    dealt = members.select("set_key", "component", "block").join(tasks, ["component", "block"]).join(content, "set_key")
    ordered = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "block", "set_key")
    return ordered.select("component", "i", "j", "block", "set_key", "shingles").mapInArrow(_verify, _FOUND)


def _classes(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(rows of ``describe``, set_key with n_copies, n_links and the class's component)."""
    rows = describe(docs, id, text)
    sets = rows.groupBy("set_key").agg(
        F.min("n").alias("n"), F.min("signature").alias("signature"), F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("n_copies")
    )
    sets = cut_lineage(sets, "distinct-sets")
    found = cut_lineage(verified(docs, rows, sets.where("n > 0"), id, text), "near-links")
    links = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("_k")).agg(F.sum("n").alias("n_links"))
    classes = connected_components(found.where(F.col("b").isNotNull()).select("a", "b"))
    out = sets.join(links, F.col("set_key") == F.col("_k"), "left").join(classes, F.col("set_key") == F.col("node"), "left")
    return rows, out.select("set_key", "first", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "set_key").alias("component"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, class_id, n_links, n_copies, class_size.

    ``n_copies``: rows with the same shingle set, itself included; ``n_links``:
    other shingle sets with a Jaccard similarity of 0.8 or more; a class holds
    copies and what links connect, its id is its smallest doc_id (null only if
    it has no other).  Null texts are empty; texts without words are copies of
    each other and have no links.  An empty table gives no rows.
    """
    rows, sets = _classes(docs, id, text)
    sets = cut_lineage(sets, "near-classes")
    size = sets.groupBy("component").agg(F.min("first.doc_id").alias("class_id"), F.sum("n_copies").alias("class_size"))
    named = sets.join(size, "component").select(F.col("set_key").alias("_k"), "class_id", "n_links", "n_copies", "class_size")
    return rows.select("doc_id", "set_key").join(named, F.col("set_key") == F.col("_k")).select("doc_id", "class_id", "n_links", "n_copies", "class_size")


def drop_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The row with the smallest id of each class (ties: by hash of the text), with all its columns whatever their names.

    Null is below every id, so a class's row without one stays.  Of rows that repeat the surviving id and text, the
    first in the order of the row's JSON text stays, whatever the order of the input.  Texts without words are
    one class.  Only rows that go or repeat are joined to the texts; an empty table gives no rows.
    """
    rows, sets = _classes(docs, id, text)
    stays = sets.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("_d"), F.col("first.text_hash").alias("_h"))
    counted = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("copies"))
    marked = counted.join(stays, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_h")), "left")
    marked = marked.select("doc_id", "text_hash", "copies", F.col("_h").isNotNull().alias("stays")).where("copies > 1 OR NOT stays")
    marked = cut_lineage(marked, "near-dropped")
    packed = docs.select(F.struct("*").alias("row"), F.col(id).cast("bigint").alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("hash"))
    found = packed.join(marked, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    found = found.where(F.coalesce("stays", F.lit(True)))
    if marked.where("stays").isEmpty():
        return found.select("row.*")
    again = F.col("stays").isNotNull()
    first = found.where(again).groupBy("id", "hash").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return found.where(~again).select("row").unionByName(first.select("row")).select("row.*")
