"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer when its smallest s-mer (by hash)
is its first or its last.  Whether it is one depends on the k-mer alone, so an
edit moves no anchor outside the k-mers it touches, and two texts that share a
passage share its anchors at a constant offset.

Likeness is taken over all distinct anchors of both texts: those that both
have, at offsets within a band of the most voted one, as a share of the anchors
(Dice).  A fingerprint is a digest beside it: the anchors with the smallest
hashes and their positions.  Equal texts have equal fingerprints and likeness 1.
Texts below a length have shorter k-mers; a pair with one of them is compared
by the shorter k-mers of both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import SubstringHash, mix64, sliding_min

#: Code points of a k-mer and of its inner s-mers; the same for texts of under ``SHORT`` code points.
K, S = 20, 9
SHORT, SHORT_K, SHORT_S = 120, 6, 3
#: Anchors in a fingerprint, at most; likeness takes all.
KEPT = 48
#: Offsets that differ by less than this are one diagonal.
BAND = 64
#: Code points hashed at once.
BLOCK = 1 << 20


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def anchors(text: str, k: int | None = None, s: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of all closed syncmers of a text; a text without one is its own anchor at 0."""
    points = _points(text)
    if k is None:
        k, s = (SHORT_K, SHORT_S) if len(points) < SHORT else (K, S)
    hashes, positions = [], []
    for a in range(0, max(1, len(points) - k + 1), BLOCK):
        piece = points[a : a + BLOCK + k - 1]  # blocks overlap so that each k-mer lies in exactly one
        sums = SubstringHash(piece)
        inner = sums.windows(s)
        least = sliding_min(inner, k - s + 1)
        at = np.flatnonzero((inner[: len(least)] == least) | (inner[k - s : k - s + len(least)] == least))
        hashes.append(sums.windows(k)[at])
        positions.append(at + a)
    h, p = np.concatenate(hashes), np.concatenate(positions)
    if not len(h):
        whole = hashlib.blake2b(points.tobytes(), digest_size=8).digest()
        return np.frombuffer(whole, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return h, p


def sketch(text: str, k: int | None = None, s: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """(anchor hashes, ascending, their first positions, number of distinct anchors)."""
    h, p = anchors(text, k, s)
    h = mix64(h)
    # First position of each hash: a stable sort keeps the order of positions.
    order = np.argsort(h, kind="stable")
    h, p = h[order], p[order]
    first = np.concatenate([[True], h[1:] != h[:-1]])
    h, p = h[first], p[first]
    return h, p, len(h)


def encode(one: tuple[np.ndarray, np.ndarray, int]) -> str:
    """A fingerprint as text: distinct anchors, then hash and position of the smallest ones, in hex."""
    h, p, n = one
    h = (h[:KEPT] >> np.uint64(32)).astype(">u4")
    return f"{n:x}:" + h.tobytes().hex() + ":" + p[:KEPT].astype(">u4").tobytes().hex()


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray, int]:
    n, h, p = fingerprint.split(":")
    return np.frombuffer(bytes.fromhex(h), ">u4").astype(np.uint32), np.frombuffer(bytes.fromhex(p), ">u4").astype(np.int64), int(n, 16)


def likeness(a: tuple[np.ndarray, np.ndarray, int], b: tuple[np.ndarray, np.ndarray, int]) -> float:
    """Share of anchors that both texts have on one diagonal, 0 to 1."""
    (ha, pa_, na), (hb, pb, nb) = a, b
    if na == nb and (ha == hb).all() and (pa_ == pb).all():
        return 1.0
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    votes = np.sort(pb[j] - pa_[i])
    # The band of offsets with the most anchors.
    matched = int((np.searchsorted(votes, votes + BAND) - np.arange(len(votes))).max())
    return 2 * matched / (na + nb)


def alike(text: str, one: tuple, other_text: str, other: tuple) -> float:
    """Likeness of two texts with their sketches; both by the shorter k-mers where one is under ``SHORT``."""
    if (len(text) < SHORT) != (len(other_text) < SHORT):
        if len(text) >= SHORT:
            one = sketch(text, SHORT_K, SHORT_S)
        else:
            other = sketch(other_text, SHORT_K, SHORT_S)
    return likeness(one, other)


def edited(text: str, following: str) -> str:
    """The last third of ``text`` (code points, rounded down) replaced by as many first ones of ``following``."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(doc_id, text, one, following, next_one):
    changed = edited(text, following)
    other = one if changed == text else sketch(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, encode(one), encode(other), alike(text, one, changed, other), alike(text, one, following, next_one)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [f.split()[0] for f in _RESULT.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def _texts(batch: pa.RecordBatch):
    for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        yield i, t or ""


def _inner_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (range, doc_id, text), sorted, whose next row is in the same range."""
    last, at, rows = None, None, []
    for batch in batches:
        for here, (doc_id, text) in zip(batch.column("range").to_pylist(), _texts(batch)):
            one = sketch(text)
            if last is not None and here == at:
                rows.append(_row(*last, text, one))
            last, at = (doc_id, text, one), here
            if len(rows) >= 2000:
                yield _batch(rows)
                rows = []
    yield _batch(rows)


def _outer_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, t, f in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))):
            rows.append(_row(i, t or "", sketch(t or ""), f or "", sketch(f or "")))
        yield _batch(rows)


def fingerprint_neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (see ``edited``), and their likenesses.

    The next document is the one with the next smaller id (null ids last; rows
    with the same id by text, descending), after the last the first.  Null
    counts as the empty text; a lone row is its own next one; repeated rows
    are rows of their own; an empty table gives no rows.

    One shuffle deals the texts to ranges of the id (their bounds are
    quantiles, one a shuffle partition).  Inside a range the next row follows;
    only the last row of each range is joined to the first of the next one, and
    those are found by their ids.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    bounds = rows.agg(F.percentile_approx("doc_id", shares)).first()[0] or []
    above = F.size(F.filter(F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast("array<bigint>"), lambda b: b > F.col("doc_id")))
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(parts + 1)).otherwise(above))
    dealt = rows.repartitionByRange(parts, "range").sortWithinPartitions("range", F.col("doc_id").desc(), F.col("text").desc())
    inner = dealt.select("range", "doc_id", "text").mapInArrow(_inner_pairs, _RESULT)
    # First and last id of each range: two ids a range, so the broadcast is bounded by the partitions.
    ends = rows.groupBy("range").agg(F.array_distinct(F.array(F.max("doc_id"), F.min("doc_id"))).alias("_ids"))
    ends = ends.select(F.col("range").alias("_range"), F.explode("_ids").alias("_id"))
    edge = rows.join(F.broadcast(ends), (F.col("range") == F.col("_range")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    pair = F.struct("doc_id", "text")
    edge = edge.groupBy("range").agg(F.max(pair).alias("first"), F.min(pair).alias("last"))
    every = Window.orderBy("range")  # a row per range
    edge = edge.withColumn("following", F.lead("first.text").over(every))
    whole = Window.partitionBy()
    start = F.min(F.struct("range", F.col("first.text").alias("text"))).over(whole)["text"]
    outer = edge.select(F.col("last.doc_id").alias("doc_id"), F.col("last.text").alias("text"), F.coalesce("following", start).alias("following"))
    return inner.unionByName(outer.mapInArrow(_outer_pairs, _RESULT))
