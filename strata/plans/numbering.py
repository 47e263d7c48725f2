"""Consecutive row numbers without funnelling a group through one task.

``row_number().over(Window.partitionBy(file).orderBy(...))`` sends each file to a
single task; a file holding a third of the rows then becomes the whole job.
``number_rows`` orders by value (range shuffle of the distinct rows, staged
once, plus one offset per range partition); ``number_in_scan_order`` numbers
rows of a file scan in physical order with no shuffle at all, plus a small
(file, block) table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Copies of one row that are expanded in one piece.
PIECE = 4096


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it (null equals null)."""
    n = len(column)
    if n < 2:
        return np.zeros(0, dtype=bool)
    differ = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), False)
    missing = np.asarray(column.is_null())
    return np.asarray(differ) | (missing[1:] != missing[:-1])


def _number_sorted(group_cols: Sequence[str]):
    """Number within the group, as far as this partition knows it, for rows sorted by group: a prefix sum of the pieces' sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = TaskContext.get().partitionId()
        last, counted, first_group = None, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            size = np.asarray(batch.column("_m")).astype(np.int64)
            new = np.zeros(n, dtype=bool)
            for c in group_cols:
                new[1:] |= _changes(batch.column(c))
            head = tuple(batch.column(c)[0].as_py() for c in group_cols)
            new[0] = last is not None and head != last
            before = np.cumsum(size) - size
            starts = np.flatnonzero(new)
            # Up to the first change the group of the last batch goes on.
            base = np.zeros(n, dtype=np.int64)
            group = np.cumsum(new)
            if len(starts):
                base = np.concatenate([[-counted], before[starts]])[group]
            else:
                base[:] = -counted
            inside = before - base
            first = (group == 0) & first_group
            first_group = first_group and not len(starts)
            counted = int(inside[-1] + size[-1])
            last = tuple(batch.column(c)[n - 1].as_py() for c in group_cols)
            extra = [pa.array(np.full(n, pid), pa.int32()), pa.array(inside, pa.int64()), pa.array(first, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "_pid", "_inside", "_first"])

    return run


def sorted_rows(df: DataFrame, keys: Sequence[str], group_cols: Sequence[str], n: int) -> DataFrame:
    """Distinct rows with their number of copies (``_m``), range-partitioned and sorted by ``keys``.

    ``_pid`` is the partition, ``_inside`` the number of the group's rows before the
    first copy in this partition, ``_first`` marks the group that the partition begins with.
    """
    ordered = [F.col(c).asc_nulls_first() for c in keys]
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_m"))
    ranged = distinct.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered)
    extra = [T.StructField("_pid", T.IntegerType()), T.StructField("_inside", T.LongType()), T.StructField("_first", T.BooleanType())]
    return ranged.mapInArrow(_number_sorted(group_cols), T.StructType([*ranged.schema.fields, *extra]))


def number_rows(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    out: str = "row_number",
    start: int = 1,
    num_partitions: int | None = None,
    piece: int = PIECE,
) -> DataFrame:
    """Number rows 1..n (plus ``start - 1``) within each ``partition_by`` group, in
    ``order_by`` order (ascending, NULLs first), the remaining columns breaking ties.

    Rows equal in every column are interchangeable, so they are first collapsed
    to (row, multiplicity) by a partial aggregate: a hot group of copies (a
    third of the data may be one line) shrinks map-side. The distinct rows have
    a total order; they are range-partitioned (balanced tasks even inside one
    huge group) and sorted, one vectorised pass gives prefix sums of the
    multiplicities within their groups, and the result is staged once as a
    parquet table in the checkpoint folder, so every later branch sees the same
    partitioning. That makes two exchanges of rows. Only the group that a
    partition begins with can have rows in earlier ones: that offset is one row
    per partition, and is broadcast.

    Rows are expanded back to their copies where they lie; a row with more than
    ``piece`` copies is first cut into pieces of that size, and these (a few light
    rows per hot line) are dealt over all tasks, which expand them.
    The result does not depend on input order, so recomputation after a lost
    executor gives the same numbers.
    """
    from strata.session import cut_lineage, ship_package

    spark = df.sparkSession
    ship_package(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = list(df.columns)
    group_cols = list(partition_by)
    keys = group_cols + [c for c in order_by if c not in group_cols]
    keys += [c for c in cols if c not in keys]
    staged = cut_lineage(sorted_rows(df, keys, group_cols, n), "numbering")
    # Rows of each partition's first group in earlier partitions; groups are contiguous, so most have none.
    counts = staged.groupBy("_pid", *group_cols).agg(F.sum("_m").alias("_cnt"), F.max("_first").alias("_begins"))
    earlier = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.sum("_cnt").over(earlier)).where(F.col("_begins") & F.col("_before").isNotNull())
    # At most one row per range partition.
    offsets = F.broadcast(offsets.select(F.col("_pid").alias("_o_pid"), "_before"))
    joined = staged.join(offsets, F.col("_pid") == F.col("_o_pid"), "left")
    before = F.when(F.col("_first"), F.coalesce("_before", F.lit(0))).otherwise(F.lit(0))
    first = joined.select(*cols, (before + F.col("_inside") + F.lit(start)).alias("_from"), "_m")

    def expand(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(c) for c in cols], F.explode(F.sequence("_from", F.col("_from") + F.col("_m") - 1)).alias(out))

    many = first.where(F.col("_m") > piece).select(
        *cols, F.explode(F.sequence("_from", F.col("_from") + F.col("_m") - 1, F.lit(piece).cast("bigint"))).alias("_piece"), (F.col("_from") + F.col("_m")).alias("_end")
    )
    pieces = many.select(*cols, F.col("_piece").alias("_from"), F.least(F.lit(piece).cast("bigint"), F.col("_end") - F.col("_piece")).alias("_m"))
    return expand(first.where(F.col("_m") <= piece)).unionByName(expand(pieces.repartition(n, "_from")))


def number_in_scan_order(
    df: DataFrame,
    file_col: str = "_file_path",
    block_col: str = "_block_start",
    out: str = "row_index",
) -> DataFrame:
    """0-based data-row index within each file, in physical order, for rows read
    straight from a file scan (before any shuffle).

    ``df`` must carry ``_metadata.file_path`` and ``_metadata.file_block_start``
    as ``file_col``/``block_col``. Each (file, block) lies consecutively inside
    one scan partition, so the position inside the block is the row's
    ``monotonically_increasing_id`` minus the block's smallest; earlier blocks
    of the same file are added from a small (file, block) table.
    """
    with_id = df.withColumn("_mid", F.monotonically_increasing_id())
    blocks = with_id.groupBy(file_col, block_col).agg(F.min("_mid").alias("_block_mid"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0))).drop("_cnt")
    joined = with_id.join(blocks, on=[file_col, block_col], how="inner")
    return joined.withColumn(out, F.col("_before") + F.col("_mid") - F.col("_block_mid")).drop(
        "_mid", "_block_mid", "_before"
    )
