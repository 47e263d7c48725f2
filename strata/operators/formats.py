"""Timestamp forms elected per file.

Trying a list of formats value by value reads ``03/04/2010`` one way in every
file. A file is written in one form: one aggregate counts, for every candidate
format at once, how many of the file's values it parses, and the form with the
most votes reads the whole file. Where a file's own values can't tell (a file of
one day, the 3rd of April), the votes of the wider group it belongs to decide,
then the order of the list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Candidates: ISO forms, day first, month first.
CANDIDATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "d/M/yyyy H:mm[:ss]",
    "M/d/yyyy H:mm[:ss]",
    "d/M/yyyy",
    "M/d/yyyy",
    "d.M.yyyy H:mm[:ss]",
    "d.M.yyyy",
)


def _votes(text: Column, formats: Sequence[str]) -> list[Column]:
    return [F.count_if(F.try_to_timestamp(text, F.lit(f)).isNotNull()).alias(f"v{i}") for i, f in enumerate(formats)]


def elect_formats(
    lines: DataFrame,
    by: Sequence[str],
    text_col: str = "InvoiceDate",
    formats: Sequence[str] = CANDIDATE_FORMATS,
    wider: Sequence[str] = (),
) -> DataFrame:
    """Per group of ``by``: ``format_index``, ``format``, the values it parses (``parsed``) and all non-null ones (``total``).

    ``wider`` names columns of ``by`` whose group decides between forms with
    equally many votes (all groups together if empty). A group without a value
    that any form parses gets the wider group's form, or null if that has none.
    Nulls in ``by`` form a group.
    """
    text = F.col(text_col)
    counted = lines.groupBy(*by).agg(F.count(text).alias("total"), *_votes(text, formats))
    votes = F.array(*[F.col(f"v{i}") for i in range(len(formats))])
    counted = counted.select(*by, "total", votes.alias("votes"))
    # The wider group's votes add up from the groups' own.
    sums = [F.sum(F.element_at("votes", i + 1)).alias(f"w{i}") for i in range(len(formats))]
    around = counted.groupBy(*wider).agg(*sums)
    around = around.select(*[F.col(c).alias(f"_w_{c}") for c in wider], F.array(*[F.col(f"w{i}") for i in range(len(formats))]).alias("around"))
    on = F.lit(True)
    for c in wider:
        on = on & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    joined = counted.join(around if wider else F.broadcast(around), on, "left")
    ranked = F.transform(F.sequence(F.lit(0), F.lit(len(formats) - 1)), lambda i: F.struct(F.get("votes", i).alias("own"), F.get("around", i).alias("wide"), (-i).alias("i")))
    best = F.array_max(ranked)
    index = F.when(best["wide"] > 0, -best["i"])
    return joined.select(*by, index.alias("format_index"), F.get(F.array(*map(F.lit, formats)), index).alias("format"), best["own"].alias("parsed"), "total")


def parse_elected(text: Column, format_index: Column, formats: Sequence[str] = CANDIDATE_FORMATS) -> Column:
    """The text read in the elected form; null where it does not fit or none is elected. One format is tried per value."""
    out = F.lit(None).cast("timestamp")
    for i, f in reversed(list(enumerate(formats))):
        out = F.when(format_index == i, F.try_to_timestamp(text, F.lit(f))).otherwise(out)
    return out


def read_elected(lines: DataFrame, elected: DataFrame, by: Sequence[str], text_col: str = "InvoiceDate", formats: Sequence[str] = CANDIDATE_FORMATS) -> DataFrame:
    """``lines`` with ``text_col`` as a timestamp in their group's elected form (one row a group: broadcast by Spark where small)."""
    keys = elected.select(*[F.col(c).alias(f"_e_{c}") for c in by], F.col("format_index").alias("_format"))
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    joined = lines.join(keys, on, "left")
    cols = [parse_elected(F.col(c), F.col("_format"), formats).alias(c) if c == text_col else F.col(c) for c in lines.columns]
    return joined.select(*cols)
