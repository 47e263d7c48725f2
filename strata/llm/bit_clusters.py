"""Centroid clustering of integer vectors held as bit planes.

A vector's ``WIDTH`` components are packed by planes: bit c of word b is bit b
of component c in two's complement, so a plane is one 64-bit word.  The dot
product of two vectors is then a sum of popcounts of ANDed planes, each weighted
by the two planes' powers of two (the top plane counts negative), and squared
distances follow from the dot product and the two norms.  All of it is integer
arithmetic, so clusters do not depend on how the rows are dealt to tasks.

The planes are staged once.  A round reads them, keeps the sums of its clusters
per task, and Spark adds those up by (cluster, component): what reaches the
driver has one row per component of a centroid, whatever the input's size.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage

#: Components of a vector: the bits of a plane's word.
WIDTH = 64
#: Integers of a vector are below 2**(PLANES - 1) in size, so that distances fit 64 bits.
PLANES = 28
#: Scale of the integers, centroids, rounds, and salt of the start.
SCALE, CENTROIDS, ROUNDS, SEED = 1024, 8, 10, 3


def quantized(vector: Column, scale: int = SCALE) -> Column:
    """The integers floor(scale * x) of a vector's components; null unless it has ``WIDTH`` finite components, none null."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    good = vector.isNotNull() & (F.size(vector) == WIDTH) & F.coalesce(finite, F.lit(False))
    return F.when(good, F.transform(x, lambda v: F.floor(v * F.lit(float(scale)))))


def pack_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """(n, WIDTH) integers as (n, planes) words, lowest plane first, two's complement."""
    bits = (values[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<u8")[:, :, 0]


def unpack_planes(words: np.ndarray) -> np.ndarray:
    """The (n, WIDTH) integers of (n, planes) words."""
    n, planes = words.shape
    bits = np.unpackbits(np.ascontiguousarray(words, dtype="<u8").view(np.uint8).reshape(n, planes, 8), axis=2, bitorder="little")
    return np.einsum("npc,p->nc", bits.astype(np.int64), plane_weights(planes))


def plane_weights(planes: int) -> np.ndarray:
    weights = np.int64(1) << np.arange(planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def dot_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact dot products of all left vectors with all right ones, both given as planes."""
    wl, wr = plane_weights(left.shape[1]), plane_weights(right.shape[1])
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    for i in range(left.shape[1]):
        counts = np.bitwise_count(left[:, i, None, None] & right[None, :, :]).astype(np.int64)
        out += wl[i] * (counts @ wr)
    return out


def distances(words: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all vectors to all centroids, both given as planes."""
    own = plane_weights(words.shape[1])
    norms = np.zeros(len(words), dtype=np.int64)
    for i in range(words.shape[1]):
        norms += own[i] * (np.bitwise_count(words[:, i, None] & words).astype(np.int64) @ own)
    return norms[:, None] + np.diag(dot_products(centroids, centroids))[None, :] - 2 * dot_products(words, centroids)


def _words(batch: pa.RecordBatch, planes: int) -> np.ndarray:
    column = batch.column("planes")
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u8").reshape(len(column), planes)


def _pack(planes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.asarray(batch.column("ints").flatten()).astype(np.int64).reshape(-1, WIDTH)
                words = pack_planes(values, planes)
                packed = pa.array([w.tobytes() for w in words.astype("<u8")], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("id"), packed], names=["id", "planes"])

    return run


def _sums(planes: int, centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, WIDTH), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            words = _words(batch, planes)
            nearest = distances(words, centroids).argmin(axis=1)
            values = unpack_planes(words)
            count += np.bincount(nearest, minlength=k)
            for c in range(k):
                total[c] += values[nearest == c].sum(axis=0)
        cluster, part = np.divmod(np.arange(k * WIDTH), WIDTH)
        columns = [pa.array(cluster, pa.int32()), pa.array(part, pa.int32()), pa.array(count[cluster]), pa.array(total.reshape(-1))]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "component", "n", "total"])

    return run


def _assign(planes: int, centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = distances(_words(batch, planes), centroids)
                nearest = away.argmin(axis=1)
                near = away[np.arange(len(away)), nearest]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(nearest, pa.int32()), pa.array(near, pa.int64())], names=["id", "cluster", "distance"]
                )

    return run


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    scale: int = SCALE,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Per kept vector: id, cluster, distance, cluster_inertia, inertia, centroid (array of its final integers).

    Kept are vectors with exactly ``WIDTH`` components, none null, NaN or
    infinite; the others give no row.  The start is the k kept vectors with the
    smallest sha256 of ``seed:id`` (equal ids by their integers; a null id is
    the text "null"); fewer vectors give fewer centroids.  Ties of distances go
    to the smaller number; repeated rows are rows of their own, an empty table
    gives an empty result.  Other columns are not read.  A component whose
    integer needs more than ``PLANES`` bits raises an error, since distances
    would not fit 64 bits.
    """
    ints = vectors.select(F.col(id).alias("id"), quantized(F.col(vector), scale).alias("ints")).where("ints is not null")
    size = F.array_max(F.transform("ints", lambda v: F.when(v < 0, -v - 1).otherwise(v)))
    # One pass for the largest integer and the start; only k rows and one number reach the driver.
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))), 256)
    start = [r.ints for r in ints.select(key.alias("key"), "ints").orderBy("key", "ints").limit(k).collect()]
    schema = f"{id} {vectors.schema[id].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>"
    if not start:
        return vectors.sparkSession.createDataFrame([], schema)
    largest = int(ints.agg(F.max(size).alias("m")).first().m)
    planes = largest.bit_length() + 1
    if planes > PLANES:
        raise ValueError(f"a component's integer needs {planes} bits; {PLANES} are supported")
    id_type = vectors.schema[id].dataType.simpleString()
    packed = cut_lineage(ints.mapInArrow(_pack(planes), f"id {id_type}, planes binary"), "planes")
    centers = np.array(start, dtype=np.int64)
    for _ in range(rounds):
        sums = packed.mapInArrow(_sums(planes, pack_planes(centers, planes)), "cluster int, component int, n long, total long")
        # At most k * WIDTH rows, whatever the number of vectors.
        for row in sums.groupBy("cluster", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            if row.n:
                centers[row.cluster, row.component] = row.total // row.n
    assigned = packed.mapInArrow(_assign(planes, pack_planes(centers, planes)), f"id {id_type}, cluster int, distance long")
    assigned = cut_lineage(assigned, "clusters")
    inertia = {r.cluster: r.d for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    facts = [(c, inertia.get(c, 0), sum(inertia.values()), [int(x) for x in centers[c]]) for c in range(len(centers))]
    facts = vectors.sparkSession.createDataFrame(facts, "c int, cluster_inertia long, inertia long, centroid array<bigint>")
    # k rows: the number of centroids bounds the broadcast.
    joined = assigned.join(F.broadcast(facts), F.col("cluster") == F.col("c"))
    return joined.select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid")
