"""Toxicity: nearest labelled examples by exact TF-IDF cosine.

The space: the words and character n-grams of the labelled examples (a bounded
sample) that the two classes use differently beyond chance.  A term is taken
when the standardised difference of its shares of the classes' examples exceeds
sqrt(2 ln W), W being the number of terms tested, the size that the largest of W
unrelated terms would reach.  A text's vector has (1 + ln n) * idf for each
of these terms, document frequencies being counted over all documents, and unit length;
what is outside the space is in no vector, as for any TF-IDF vocabulary.

The examples are kept in an inverted index.  Short posting lists are added up
for all examples; long ones are cut into blocks of examples that lie in the
order of their heaviest terms, with the largest weight of each term in each
block.  A query's bound for a block is its largest sum of short lists and the
dot product with those maxima; blocks are scored in order of their bounds until
no bound can reach the k-th best cosine, so the k nearest are exact.  Their
cosines vote, and a logistic curve fitted on leave-one-out votes turns the vote
into a probability.  The neighbours' ids and cosines are the evidence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import ranges, text_chunks
from strata.session import cut_lineage

#: Examples of each class in the index, at most.
EXAMPLES = 1024
#: Posting lists with at least one in so many examples are dense in blocks.
LONG = 16
#: Texts that are scored at once.
TOGETHER = 64
#: Neighbours that vote, and examples in a block of the index.
NEIGHBOURS, BLOCK = 15, 64
#: Weight of the prior in a vote, in units of cosine.
PRIOR = 0.5
THRESHOLD = 0.5

#: Lengths of the character n-grams.
NGRAMS = (3, 4, 5, 6)
#: Words whose terms a task remembers, at most.
REMEMBERED = 300_000

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(word: str) -> set[str]:
    """The word itself (between blanks) and its n-grams, its ends marked by blanks."""
    w = f" {word} "
    return {w} | {w[i : i + n] for n in NGRAMS for i in range(len(w) - n + 1)}


class TermCounter:
    """Counts of a vocabulary's terms in texts; remembers the terms of what stands between blanks."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self._term = {t: i for i, t in enumerate(terms)}
        self._known: dict[str, np.ndarray | None] = {}
        # All terms inside a word in one pass over its characters.
        self._inside = ahocorasick.Automaton()
        for t, i in self._term.items():
            self._inside.add_word(t, i)
        if terms:
            self._inside.make_automaton()

    def __getstate__(self):
        return "\n".join(self._term)

    def __setstate__(self, state):
        self.__init__(state.split("\n") if state else [])

    def _terms(self, token: str) -> np.ndarray | None:
        """Numbers of the terms of a token's words, one entry per word that has it; None if there are none."""
        if not self._term:
            return None
        found: list[int] = []
        for word in [token] if token.isalpha() else _WORD.findall(token):
            found += {i for _, i in self._inside.iter(f" {word} ")}
        return np.array(found, dtype=np.int64) if found else None

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the terms, ascending, and how often each occurs)."""
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known, found, times = self._known, [], []
        for token, n in Counter((text or "").lower().split()).items():
            try:
                ids = known[token]
            except KeyError:
                ids = known[token] = self._terms(token)
            if ids is not None:
                found.append(ids)
                times.append(n)
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        counts = np.bincount(np.concatenate(found), np.repeat(times, [len(f) for f in found])).astype(np.int64)
        terms = np.flatnonzero(counts)
        return terms, counts[terms]


class BlockMaxIndex:
    """Exact k nearest examples by cosine; ``vectors`` are (terms, weights) of unit length."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.block = len(vectors), block
        lengths = np.array([len(t) for t, _ in vectors], dtype=np.int64)
        terms = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        order = np.argsort(terms, kind="stable")
        self.example = np.repeat(np.arange(self.n, dtype=np.uint16 if self.n < 1 << 16 else np.int32), lengths)[order]
        self.weight = np.concatenate([np.zeros(0, np.float32), *(w for _, w in vectors)])[order]
        self.length = np.bincount(terms, minlength=n_terms)
        self.start = np.cumsum(self.length) - self.length
        self._lay_out()

    def _lay_out(self) -> None:
        self.start = np.cumsum(self.length) - self.length
        # Long lists as rows of a term's weights in each block, 0 where an example lacks it; -1 marks short lists.
        long = np.flatnonzero(self.length * LONG >= max(self.n, LONG))
        self.place = np.full(len(self.length), -1, dtype=np.int32)
        self.place[long] = np.arange(len(long))
        self.rows = np.zeros((max(1, -(-self.n // self.block)), len(long), self.block), dtype=np.float32)
        at = np.repeat(self.place, self.length)
        use = at >= 0
        e = self.example[use]
        self.rows[e // self.block, at[use], e % self.block] = self.weight[use]
        self.most = self.rows.max(axis=2)

    def __getstate__(self):
        """Only the posting lists are sent; the rest is laid out again."""
        return self.n, self.block, self.example, self.weight, self.length.astype(np.int32)

    def __setstate__(self, state):
        self.n, self.block, self.example, self.weight, length = state
        self.length = length.astype(np.int64)
        self._lay_out()

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(example numbers, cosines) of the k nearest with a cosine above 0, and the blocks scored.

        Ties go to the smaller example number.
        """
        return self.nearest_of([(terms, weights)], k)[0]

    def nearest_of(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
        """``nearest`` of each query; a block is multiplied with all queries whose bounds reach it."""
        blocks, n_long, _ = self.rows.shape
        sims = np.zeros((len(queries), blocks, self.block), dtype=np.float32)
        dense = np.zeros((len(queries), n_long), dtype=np.float32)
        for q, (terms, weights) in enumerate(queries):
            at = self.place[terms]
            dense[q, at[at >= 0]] = weights[at >= 0]
            short = terms[at < 0]
            lengths = self.length[short]
            posting = np.repeat(self.start[short], lengths) + ranges(lengths)
            sums = np.bincount(self.example[posting], np.repeat(weights[at < 0], lengths) * self.weight[posting], blocks * self.block)
            sims[q] = sums.reshape(blocks, self.block)
        bounds = dense @ self.most.T + sims.max(axis=2)
        best = np.zeros((len(queries), k), dtype=np.float32)  # the k largest cosines so far
        scored = np.zeros((len(queries), blocks), dtype=bool)
        for b in np.argsort(-bounds.max(axis=0, initial=0), kind="stable"):
            live = np.flatnonzero((bounds[:, b] > 0) & (bounds[:, b] >= best.min(axis=1) - 1e-5))
            if not len(live):
                continue
            sims[live, b] += dense[live] @ self.rows[b]
            scored[live, b] = True
            both = np.concatenate([best[live], sims[live, b]], axis=1)
            best[live] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        sims[~scored] = 0
        out = []
        for s, least, n in zip(sims.reshape(len(queries), -1), best.min(axis=1), scored.sum(axis=1)):
            hit = np.flatnonzero((s > 0) & (s >= least))
            hit = hit[np.lexsort((hit, -s[hit]))[:k]]
            out.append((hit, s[hit], int(n)))
        return out


def _logit(vote):
    v = np.clip(vote, 1e-3, 1 - 1e-3)
    return np.log(v / (1 - v))


class Model:
    """The space's terms with their inverse document frequencies, the example index and the calibration."""

    def __init__(self, terms: list[str], idf: np.ndarray, examples: list[tuple[int, int, np.ndarray, np.ndarray]], share: float):
        self.counts = TermCounter(terms)
        self.idf = idf.astype(np.float32)
        self.share = share
        vectors = [self._vector(t, n) for _, _, t, n in examples]
        # Examples with the same heaviest terms lie together, so that a block's maxima say much about it.
        use = sorted((i for i, v in enumerate(vectors) if len(v[0])), key=lambda i: vectors[i][0][np.argsort(-vectors[i][1], kind="stable")].tolist())
        self.ids = np.array([examples[i][0] for i in use], dtype=np.int64)
        self.labels = np.array([examples[i][1] for i in use], dtype=np.float64)
        self.index = BlockMaxIndex([vectors[i] for i in use], len(terms))
        self.slope, self.shift = 1.0, 0.0
        # Left out, an example loses the terms that no other one has.
        others = [self._vector(t[self.index.length[t] > 1], n[self.index.length[t] > 1]) for _, _, t, n in examples]
        self._calibrate(others, use, [e[1] for e in examples])

    def _vector(self, terms: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(counts.astype(np.float32))) * self.idf[terms]
        norm = np.sqrt((w * w).sum())
        return terms, (w / norm if norm else w).astype(np.float32)

    def _vote(self, labels: np.ndarray, sims: np.ndarray) -> float:
        return float((sims @ labels + PRIOR * self.share) / (sims.sum() + PRIOR))

    def _calibrate(self, vectors, use, labels) -> None:
        """Logistic curve on the log odds of leave-one-out votes, the classes weighted by their share among the labels."""
        place = {e: k for k, e in enumerate(use)}
        votes, y = [], np.array(labels, dtype=np.float64)
        for e, (i, s, _) in enumerate(self._nearest(vectors, NEIGHBOURS + 1)):
            other = i != place.get(e, -1)
            votes.append(self._vote(self.labels[i[other][:NEIGHBOURS]], s[other][:NEIGHBOURS]))
        if len(set(labels)) < 2:
            return
        x = _logit(np.array(votes))
        weight = np.where(y == 1, self.share / max(y.sum(), 1), (1 - self.share) / max((1 - y).sum(), 1)) * len(y)
        a, b = 1.0, 0.0
        for _ in range(200):  # damped Newton steps with a small ridge
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([(weight * (p - y) * x).sum() + 0.01 * a, (weight * (p - y)).sum()])
            v = weight * p * (1 - p) + 1e-9
            h = np.array([[(v * x * x).sum() + 0.01, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]])
            da, db = np.clip(np.linalg.solve(h, g), -2, 2)
            a, b = a - da, b - db
            if abs(da) + abs(db) < 1e-9:
                break
        self.slope, self.shift = float(a), float(b)

    def _nearest(self, vectors, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for a in range(0, len(vectors), TOGETHER):
            yield from self.index.nearest_of(vectors[a : a + TOGETHER], k)

    def scores(self, texts: list[str | None]) -> Iterator[tuple[float, list[int], list[float]]]:
        """(probability, ids of the neighbours, their cosines) of each text."""
        for i, s, _ in self._nearest([self._vector(*self.counts(t)) for t in texts], NEIGHBOURS):
            z = self.slope * _logit(self._vote(self.labels[i], s)) + self.shift
            yield float(1 / (1 + np.exp(-np.clip(z, -40, 40)))), self.ids[i].tolist(), s.tolist()


def _terms_used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each class, how many of a batch's texts have each term."""
    for batch in batches:
        count: tuple[Counter, Counter] = Counter(), Counter()
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            count[label].update(set().union(*map(terms_of, set(words(text)))))
        every = sorted({*count[0], *count[1]})
        yield pa.RecordBatch.from_arrays(
            [pa.array(every, pa.string()), *(pa.array([c[t] for t in every], pa.int64()) for c in count)], names=["term", "n0", "n1"]
        )


def telling_terms(examples: DataFrame, sizes: tuple[int, int]) -> list[str]:
    """The terms of the space, sorted; ``examples`` has text and label, ``sizes`` the number of examples of each class."""
    counts = examples.mapInArrow(_terms_used, "term string, n0 long, n1 long").groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = cut_lineage(counts, "example-terms")
    tested = counts.count()
    if not tested or not all(sizes):
        return []
    share = (F.col("n0") + F.col("n1")) / sum(sizes)
    error = F.sqrt(share * (1 - share) * (1 / sizes[0] + 1 / sizes[1]))
    apart = F.abs(F.col("n1") / sizes[1] - F.col("n0") / sizes[0])
    # Of unrelated terms few pass; what reaches the driver is bounded by the examples.
    return sorted(r.term for r in counts.where(apart > error * float(np.sqrt(2 * np.log(max(tested, 2))))).select("term").collect())


def _term_counts(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(terms.value)
        for batch in batches:
            got = [counter(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([t for t, _ in got], pa.list_(pa.int32())),
                    pa.array([n for _, n in got], pa.list_(pa.int32())),
                ],
                names=["doc_id", "label", "terms", "counts"],
            )

    return run


def _document_frequency(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter(terms.value)
        found = np.zeros(len(terms.value) + 1, dtype=np.int64)  # the last counts documents
        for batch in batches:
            for t in batch.column("text").to_pylist():
                found[counter(t)[0]] += 1
                found[-1] += 1
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(found[used])], names=["term", "df"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str, examples: int = EXAMPLES) -> Model:
    """Model from at most ``examples`` labelled rows of each class; document frequencies from all of ``docs``.

    ``labels`` has doc_id and the 0/1 column ``label``; rows with nulls there
    are left out.  An id with labels of both classes is an example of both; a
    document row that repeats is an example each time.  The driver gets the
    space's terms, with one count a term and their counts in each example.
    Empty tables, or examples of one class only, give a model that scores every
    text by the share of label 1.
    """
    sc = docs.sparkSession.sparkContext
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    share = known.agg(F.avg("label")).first()[0]
    # The smallest hashes of the ids of each class: 2 * `examples` ids at most.
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ids = known.withColumn("place", place).where(F.col("place") <= examples).select("doc_id", "label")
    rows = cut_lineage(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), "toxicity-examples")
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    terms = telling_terms(rows, (sizes.get(0, 0), sizes.get(1, 0)))
    if not terms:
        return Model([], np.zeros(0), [], 0.5 if share is None else float(share))
    named = sc.broadcast(terms)
    got = docs.select("text").mapInArrow(_document_frequency(named), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(terms) + 1)
    df[got["term"].to_numpy()] = got["df"].to_numpy()
    idf = np.log((df[-1] + 1) / (df[:-1] + 1)) + 1
    counted = rows.mapInArrow(_term_counts(named), "doc_id long, label int, terms array<int>, counts array<int>").collect()
    picked = [(r.doc_id, r.label, np.array(r.terms, dtype=np.int64), np.array(r.counts, dtype=np.int64)) for r in counted]
    picked.sort(key=lambda e: (e[0], e[1], e[2].tolist(), e[3].tolist()))
    return Model(terms, idf, picked, float(share))


def _scorer(model, carry: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in text_chunks(batches):
            got = list(m.scores(batch.column("text").to_pylist()))
            columns = [
                *(batch.column(c) for c in carry),
                pa.array([g[0] for g in got], pa.float64()),
                pa.array([g[1] for g in got], pa.list_(pa.int64())),
                pa.array([g[2] for g in got], pa.list_(pa.float32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*carry, "score", "neighbours", "cosines"])

    return run


def score(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all of them if None), ``score``, ``neighbours`` and ``cosines`` (the evidence, nearest first).

    Null and empty texts, and those without a term of the space, score by the
    prior and have no neighbours; every row is scored, repeated ones alike, long texts whole. An empty
    table gives an empty result.
    """
    carry = docs.columns if carry is None else carry
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    more = [T.StructField("score", T.DoubleType()), T.StructField("neighbours", T.ArrayType(T.LongType())), T.StructField("cosines", T.ArrayType(T.FloatType()))]
    return docs.mapInArrow(_scorer(broadcast, carry), T.StructType([*(docs.schema[c] for c in carry), *more]))
