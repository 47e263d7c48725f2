"""Quality classifier: supervised subword embeddings.

Every word, every character n-gram inside a word (word ends included) and
every immediate repetition of a word is hashed to a row of an embedding table.
A document is the mean of its rows; a softmax layer on the mean gives the
class.  Table and layer are learned together by numpy stochastic gradient
descent on a bounded sample of labelled rows.  The output is linear in the
mean, so a document's score is the softmax of the mean of one number a
feature, and the broadcast model is one float array of ``BUCKETS`` entries.

Texts are read whole, in blocks, so memory does not grow with their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import SubstringHash, mix64, quoted, text_chunks

#: Rows of the embedding table, and its width.
BUCKETS, DIM = 1 << 17, 12
#: Labelled rows that training takes at most (by hash of the id).
SAMPLE_ROWS = 6000
EPOCHS, RATE = 5, 0.4
#: Lengths of the character n-grams, in UTF-8 bytes.
NGRAMS = (3, 4)
#: A document counts as good from this score on.
THRESHOLD = 0.3
#: Text bytes that are hashed at once.
BLOCK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(raw: bytes) -> np.ndarray:
    """Hashed features of a piece of text, one entry per occurrence."""
    b = _LOWER[np.frombuffer(b" " + raw + b" ", dtype=np.uint8)]
    space = _SPACE[b]
    b = np.where(space, np.uint8(32), b)
    hashes = SubstringHash(b)
    before = np.concatenate([[0], np.cumsum(space)])
    out = []
    for n in NGRAMS:
        h = hashes.windows(n)
        # Blanks may only be the first or last byte: the ends of a word.
        inside = before[n - 1 : n - 1 + len(h)] - before[1 : 1 + len(h)]
        out.append(h[inside == 0])
    edge = np.flatnonzero(np.diff(space.astype(np.int8)))
    start, end = edge[::2] + 1, edge[1::2] + 1
    words = hashes.spans(start, end)
    out.append(words ^ np.uint64(0x5555555555555555))
    again = words[1:][words[1:] == words[:-1]]
    out.append(np.full(len(again) * 4, 0x1234567, dtype=np.uint64))
    out.append(np.full(1, 0x7654321, dtype=np.uint64))  # an empty text has one feature too
    return (mix64(np.concatenate(out)) % np.uint64(BUCKETS)).astype(np.int32)


def blocks(raw: bytes) -> Iterator[bytes]:
    """A long text in pieces cut at blanks (at any byte if a word is longer than a block)."""
    a = 0
    while len(raw) - a > BLOCK:
        cut = raw.rfind(b" ", a + BLOCK // 2, a + BLOCK)
        cut = a + BLOCK if cut < 0 else cut
        yield raw[a:cut]
        a = cut
    yield raw[a:]


def bag(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(features, share of each) of a whole text."""
    counts: dict[int, int] = {}
    ids = n = None
    for piece in blocks(raw):
        i, c = np.unique(features(piece), return_counts=True)
        if ids is None:
            ids, n = i, c
        else:
            for k, v in zip(i.tolist(), c.tolist()):
                counts[k] = counts.get(k, 0) + v
    if counts:
        for k, v in zip(ids.tolist(), n.tolist()):
            counts[k] = counts.get(k, 0) + v
        ids, n = np.array(list(counts), dtype=np.int32), np.array(list(counts.values()))
    return ids, (n / n.sum()).astype(np.float32)


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """SGD on softmax cross entropy; returns the number of each feature and the bias (log odds of label 1).

    Without examples of both classes the model is constant: the share of 1.
    """
    labels = np.asarray(labels, dtype=np.int64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    if len(set(labels.tolist())) < 2:
        return np.zeros(BUCKETS, dtype=np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            ids, weight = bags[k]
            hidden = weight @ embed[ids]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = layer.T @ p
            layer -= rate * np.outer(p, hidden).astype(np.float32)
            bias -= rate * 0.1 * p
            # Weights are shares of a document; scaled up, rare features move as in a per-token update.
            embed[ids] -= (rate * 20) * weight[:, None] * back[None, :]
    numbers = embed @ (layer[1] - layer[0])
    return numbers.astype(np.float32), float(bias[1] - bias[0])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [bag((t or "").encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("label"),
                pa.array([i.tobytes() for i, _ in found], pa.binary()),
                pa.array([w.tobytes() for _, w in found], pa.binary()),
            ],
            names=["doc_id", "label", "ids", "weights"],
        )


def fit(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """Model from at most ``sample_rows`` labelled rows (the smallest hashes of their ids).

    ``labels`` has doc_id and the 0/1 column ``label``; rows with nulls there
    are left out; a row that repeats with both classes is an example of each.
    Where ids repeat in ``docs``, the sample is its first ``2 * sample_rows`` rows by
    id.  Only hashed features of the sample reach the driver.
    """
    chosen = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(sample_rows)
    )
    # At most sample_rows ids of 8 bytes: a bounded broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    got = rows.mapInArrow(_bags, "doc_id long, label int, ids binary, weights binary").orderBy("doc_id", F.md5("ids")).limit(2 * sample_rows).collect()
    bags = [(np.frombuffer(r.ids, dtype=np.int32), np.frombuffer(r.weights, dtype=np.float32)) for r in got]
    return train(bags, np.array([r.label for r in got], dtype=np.int64))


def _scorer(model, carry: list[str], text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, bias = model.value
        for batch in text_chunks(batches, text):
            out = []
            for t in batch.column(text).to_pylist():
                total, n = 0.0, 0
                for piece in blocks((t or "").encode("utf-8", "surrogatepass")):
                    ids = features(piece)
                    total += float(numbers[ids].sum(dtype=np.float64))
                    n += len(ids)
                out.append(1 / (1 + np.exp(-np.clip(total / n + bias, -40, 40))))
            columns = [*(batch.column(c) for c in carry), pa.array(out, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, float], carry: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``carry`` of ``docs`` (all of them if None) and ``name``: the probability of label 1.

    Null texts score as empty ones; every row is scored, repeated ones too,
    by its whole text whatever the length; an empty table gives no rows.
    """
    carry = docs.columns if carry is None else carry
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    # Plain names on the way through Arrow: the caller's may hold dots or "score".
    plain = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(quoted(c)).alias(p) for c, p in zip(carry, plain)], *([] if "text" in carry else [F.col("text")]))
    text = plain[carry.index("text")] if "text" in carry else "text"
    schema = T.StructType([*(T.StructField(p, docs.schema[c].dataType) for c, p in zip(carry, plain)), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(_scorer(broadcast, plain, text), schema).toDF(*carry, name)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels whose rows training may see: crc32 of the id's text is no multiple of 5."""
    return labels.where(~held_out("doc_id"))


def held_out(id: str) -> "F.Column":
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
