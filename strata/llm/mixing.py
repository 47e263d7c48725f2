"""Mixing sources to target weights.

Every row gets a hash-random key; rows are laid out by source and by range of
the key, prefix sums of the token counts are taken in two levels (ranges of a
source, rows of a range), and each source is cut at its exact budget.  A
budget above the source's size repeats whole epochs first.

No source is one task: the key is uniform, so its leading hex digits split
even a source with a third of all rows into ranges of equal size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import quoted

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: A target is at most so many times its source's size.
MOST_EPOCHS = 3
#: Rows of a source that one range of keys has, about.
ROWS_PER_RANGE = 20_000


def word_count(text: Column | str) -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) -> the same with ``target``.

    Sources share the sum of all sizes by weight; a target stops at ``most``
    times its source's size and the excess is shared again until none is
    above.  That is the water level L with target = min(cap, L x weight):
    sources are taken by rising cap per weight, and L follows from the first
    that stays below its cap.  One row per source; all sizes 0: all targets 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(w) for w in weights])
    ranked = totals.withColumn("_weight", F.element_at(kinds, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_cap", F.lit(most) * F.col("source_size"))
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_level.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_weight").over(rest)
    ranked = ranked.withColumn("_level", F.when(level * F.col("_weight") <= F.col("_cap"), level))
    ranked = ranked.withColumn("_level", F.max("_level").over(every))
    target = F.when(F.col("_level").isNull() | (F.col("_cap") <= F.col("_level") * F.col("_weight")), F.col("_cap").cast("double"))
    return ranked.select("source", "source_size", target.otherwise(F.col("_level") * F.col("_weight")).alias("target"))


def _taken(docs: DataFrame, id: str, text: str, source: str, size: Column | None, weights: tuple[int, ...], most: int) -> DataFrame:
    """row (the caller's, whole), text, size, source_size, target and taken of every row (see ``mix``)."""
    sized = docs.select(
        F.struct("*").alias("row"),
        F.col(id).alias("id"),
        F.col(text).alias("text") if text in docs.columns else F.lit(None).cast("string").alias("text"),
        F.col(source).alias("source"),
        (word_count(F.col(text)) if size is None else size).alias("size"),
        F.md5(F.coalesce(F.col(id).cast("string"), F.lit(""))).alias("key"),
    )
    rows = docs.groupBy(source).count().agg(F.max("count")).first()[0] or 0
    digits = max(1, math.ceil(math.log(max(1, rows / ROWS_PER_RANGE), 16)))
    sized = sized.withColumn("range", F.substring("key", 1, digits))
    sums = sized.groupBy(F.col("source").alias("_source"), F.col("range").alias("_range")).agg(F.sum("size").alias("_sum"))
    per_source = sums.groupBy(F.col("_source").alias("source")).agg(F.sum("_sum").alias("source_size"))
    quota = targets(per_source, weights, most).withColumnRenamed("source", "_q_source")
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    plan = sums.withColumn("before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    plan = plan.join(quota, F.col("_source").eqNullSafe(F.col("_q_source"))).drop("_q_source")
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range"))).drop("_source", "_range")
    inside = Window.partitionBy("source", "range").orderBy("key", F.col("id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    partial = F.greatest(F.lit(0), F.least(F.col("size"), rest - start))
    return out.select("row", "text", "size", "source_size", "target", (epochs * F.col("size") + partial).cast("bigint").alias("taken"))


def mix(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
) -> DataFrame:
    """The rows of ``docs`` with __size, __source_size, __target and __taken (words the mix takes of the row).

    Every row is returned, those of which nothing is taken too.  A row is
    taken whole once per epoch; in the last epoch the row at the cut gives the
    words up to the exact budget.  Order of a source: MD5 of the id's text,
    id, size (null ids last).  A null source is a source; null or empty texts
    have size 0 and give nothing; rows that repeat are rows of their own.
    ``size`` replaces the word count of the text.  Other columns may have any names.
    """
    out = _taken(docs, id, text, source, size, weights, most)
    return out.select("row.*", *[F.col(c).alias(f"__{c}") for c in ("size", "source_size", "target", "taken")])


def mixed_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself, with the columns of ``docs`` whatever their names: a row per epoch, the cut row with its
    first words only (one blank between them).

    Rows of which nothing is taken are left out, empty texts among them (the
    mix asks no words of them).  Null sources, repeated rows and ties are as in
    ``mix``; texts of any length are cut whole; an empty table gives no rows.
    """
    taken = _taken(docs, id, text, source, None, WEIGHTS, MOST_EPOCHS)
    whole = F.floor(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))
    part = F.col("taken") - whole * F.col("size")
    copies = F.concat(F.array_repeat(F.col("size"), whole.cast("int")), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<bigint>")))
    out = taken.withColumn("words", F.explode(copies))
    words = F.slice(F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), F.lit(1), F.col("words").cast("int"))
    first = F.when(F.col("words") < F.col("size"), F.array_join(words, " ")).otherwise(F.col("text"))
    return out.select(F.col("row").withField(quoted(text), first).alias("row")).select("row.*")
