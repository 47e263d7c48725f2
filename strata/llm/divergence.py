"""Divergence of a language's sources by their terms, with late strings.

The texts are read once.  A task counts terms per (language, source) for all
its documents and writes one row per term: its digest, its string, and its
entries (digests of language and group, two counts).  The file is columnar, so
all that follows reads and shuffles the fixed-width digests alone:

* occurrences per (group, term) and documents per (language, term);
* for the terms that a language keeps, the smallest and the largest string of
  each digest.  Where they differ, terms share the digest; the counts of these
  digests (and no others) are taken again from their strings, so that each term
  becomes an entry of its own;
* shares, distances between sources, and ranks.

Strings come back for the rows that are returned.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import text_chunks
from strata.session import cut_lineage

#: Least documents of a kept term, smoothing count, scale of the shares, ranks of a source's terms.
LEAST, SMOOTH, SCALE, RANKS = 30, 5, 1_000_000_000, 50
#: Sources of a language that are compared in one block; more are compared block by block.
BLOCK = 256
#: (group, term) entries that a task holds before it writes them (twice as many (row, term) ones before it adds them up).
ENTRIES = 4_000_000

#: Letters A-Z become lower-case, every other byte below 128 ends a term; bytes from 128 on stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BLANK = re.compile(rb" +")


def terms(text: str) -> list[bytes]:
    """The terms of a text: runs of letters A-Z, a-z and characters from U+0080 on, A-Z lower-cased."""
    return [t for t in text.encode("utf-8", "surrogatepass").translate(_FOLD).split(b" ") if t]


def digest(term: bytes, bits: int = 64) -> int:
    """A signed 64-bit digest of a term (``bits`` below 64 only to force collisions in tests)."""
    import xxhash

    x = xxhash.xxh3_64_intdigest(term) & ((1 << bits) - 1)
    return x - (1 << 64) if x >> 63 else x


_POSTINGS = "term_key long, term string, entries array<struct<lang_key:bigint,group_key:bigint,n:bigint,documents:bigint>>"
_ENTRY = pa.struct([("lang_key", pa.int64()), ("group_key", pa.int64()), ("n", pa.int64()), ("documents", pa.int64())])


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


def _compact(held: list[np.ndarray]) -> list[np.ndarray]:
    """One (key, occurrences, documents) entry per key, in the order of keys."""
    keys, n, documents = (np.concatenate(c) for c in zip(*held))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    return [(keys[first], np.add.reduceat(n[order], first), np.add.reduceat(documents[order], first))] if len(keys) else []


def _count(bits: int, entries: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, groups, held, size = _Numbers(), {}, [], 0

        def flush():
            """A row per term: its string once, and its entries of all groups."""
            for keys, n, documents in held:
                term, group = keys >> 24, keys & 0xFFFFFF
                pairs = np.array(list(groups), dtype=np.int64)
                words = list(numbers)
                digests = np.fromiter((digest(w, bits) for w in words), dtype=np.int64, count=len(words))
                start = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
                bounds = np.concatenate([start, [len(term)]])
                for a in range(0, len(start), 50_000):
                    cut = slice(bounds[a], bounds[min(a + 50_000, len(start))])
                    which = term[start[a : a + 50_000]]
                    columns = [pairs[group[cut], 0], pairs[group[cut], 1], n[cut], documents[cut]]
                    items = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_ENTRY))
                    offsets = pa.array(bounds[a : a + len(which) + 1] - bounds[a], pa.int32())
                    strings = pa.array([words[i].decode("utf-8", "surrogatepass") for i in which.tolist()], pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(digests[which]), strings, pa.ListArray.from_arrays(offsets, items)], names=["term_key", "term", "entries"])

        for batch in text_chunks(batches, target=2_000_000):
            look = numbers.__getitem__
            ids, lengths = [], []
            for text in batch.column("text").to_pylist():
                found = terms(text)
                ids.append(np.fromiter(map(look, found), dtype=np.int64, count=len(found)))
                lengths.append(len(found))
            group = np.array([groups.setdefault(g, len(groups)) for g in zip(*(batch.column(c).to_pylist() for c in ("lang_key", "group_key")))], dtype=np.int64)
            # Occurrences per (row, term), then one entry per (term, group).
            keys = np.repeat(np.arange(len(ids)) << 40, lengths) | np.concatenate(ids)
            keys, n = np.unique(keys, return_counts=True)
            held.append((((keys & ((1 << 40) - 1)) << 24) | group[keys >> 40], n, np.ones(len(n), dtype=np.int64)))
            size += len(n)
            if size > entries or len(groups) > 1 << 22:
                held = _compact(held)
                size = sum(len(h[0]) for h in held)
                if 2 * size > entries or len(groups) > 1 << 22:
                    yield from flush()
                    numbers, groups, held, size = _Numbers(), {}, [], 0
        if held:
            held = _compact(held)
            yield from flush()

    return run


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences of all pairs of two blocks of sources, for rows sorted by (lang_key, i, j)."""
    names = ["lang_key", "i", "j", "a", "b", "value"]
    now, total = None, None

    def out():
        a, b = np.indices(total.shape).reshape(2, -1)
        columns = [pa.array(np.full(a.size, now[0]), pa.int64()), pa.array(np.full(a.size, now[1]), pa.int32()), pa.array(np.full(a.size, now[2]), pa.int32())]
        columns += [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(total.reshape(-1), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def dense(column, base):
        values = np.asarray(column.flatten().field("p"))
        place = np.asarray(column.flatten().field("at"))
        counts = np.diff(np.asarray(column.offsets))
        shares = np.tile(base, (len(column), 1))
        shares[np.repeat(np.arange(len(column)), counts), place] = values
        return shares

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(c)).astype(np.int64) for c in ("lang_key", "i", "j")])
        cuts = [0, *(np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            key = tuple(keys[:, s].tolist())
            part = batch.slice(s, e - s)
            base = [np.array(part.column(c)[0].as_py(), dtype=np.int64) for c in ("base_i", "base_j")]
            if key != now:
                if now is not None:
                    yield out()
                now, total = key, np.zeros((len(base[0]), len(base[1])), dtype=np.int64)
            for a in range(0, e - s, 256):
                rows = part.slice(a, 256)
                left, right = dense(rows.column("left"), base[0]), dense(rows.column("right"), base[1])
                for k in range(left.shape[1]):
                    total[k] += np.abs(left[:, k : k + 1] - right).sum(axis=0)
    if now is not None:
        yield out()


def _share(n: Column, total: Column, vocabulary: Column, smooth: int, scale: int) -> Column:
    """1 + floor(scale * (n + smooth) / (total + smooth * vocabulary)) in integers of 38 digits."""
    wide = "decimal(38,0)"
    top = ((n + F.lit(smooth)).cast("decimal(19,0)") * F.lit(scale).cast("decimal(18,0)")).cast(wide)
    bottom = total + F.lit(smooth) * vocabulary
    return F.when(bottom > 0, F.lit(1) + F.call_function("div", top, bottom.cast(wide)))


def source_divergence(
    docs: DataFrame,
    lang: str = "lang",
    source: str = "source",
    text: str = "text",
    least: int = LEAST,
    smooth: int = SMOOTH,
    scale: int = SCALE,
    ranks: int = RANKS,
    bits: int = 64,
    block: int = BLOCK,
    entries: int = ENTRIES,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for each (lang, source) that occurs.

    Null texts, languages and sources are empty strings.  A language keeps the
    terms in at least ``least`` of its rows; a group or language gives a kept
    term the share 1 + floor(scale * (n + smooth) / (N + smooth * V)).  Part
    ``pair``: each other source of the language and the sum of the absolute
    differences of their shares (0 without kept terms).  Part ``term``: the
    ``ranks`` kept terms that occur in the group and exceed the language's share
    most, with the excess.  Equal values rank by the item's UTF-8 bytes.
    Repeated rows count each, long texts whole; an empty table and a language
    with one source and no excess give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    groups = cut_lineage(named.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")), "groups")
    # Digests of languages and groups must tell them apart; a seed under which they do is found at once in practice.
    for seed in range(64):
        keys = [F.xxhash64(F.lit(seed), F.col("lang")), F.xxhash64(F.lit(seed), F.col("lang"), F.lit("\x00"), F.col("source"))]
        check = groups.select("lang", "source", keys[0].alias("l"), keys[1].alias("g"))
        found = check.agg(*[F.count_distinct(c).alias(c) for c in ("lang", "l", "g")], F.count(F.lit(1)).alias("n")).first()
        if found.lang == found.l and found.n == found.g:
            break
    keyed = named.select(keys[0].alias("lang_key"), keys[1].alias("group_key"), "text")
    groups = groups.select("lang", "source", keys[0].alias("lang_key"), keys[1].alias("group_key"))
    postings = cut_lineage(keyed.mapInArrow(_count(bits, entries), _POSTINGS), "postings")

    # Digests only: counts of (group, term), documents of (language, term), kept terms.
    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("lang_key", "group_key", "term_key", "split").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))

    def kept_of(counts: DataFrame) -> DataFrame:
        by_lang = counts.groupBy("lang_key", "term_key", "split").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"))
        return by_lang.where(F.col("documents") >= least).drop("documents")

    whole = F.lit("").alias("split")
    counts = cut_lineage(counted(postings.select("term_key", whole, F.inline("entries"))), "counts")
    candidates = cut_lineage(kept_of(counts).select("lang_key", "term_key", "split", "lang_n"), "candidates")
    wanted = candidates.select("term_key").distinct()
    strings = postings.select("term_key", "term").join(wanted, "term_key", "left_semi")
    strings = cut_lineage(strings.groupBy("term_key").agg(F.min("term").alias("term"), F.max("term").alias("last")), "terms")
    shared = strings.where(F.col("term") != F.col("last")).select("term_key")
    if shared.isEmpty():
        kept, dictionary = candidates, strings.select("term_key", F.lit("").alias("split"), "term")
    else:
        # Terms that share a digest are counted by their strings.
        again = postings.join(shared, "term_key", "left_semi").select("term_key", F.col("term").alias("split"), F.inline("entries"))
        again = cut_lineage(counted(again), "split-counts")
        counts = counts.join(shared, "term_key", "left_anti").unionByName(again)
        kept = candidates.join(shared, "term_key", "left_anti").unionByName(kept_of(again).select(*candidates.columns))
        dictionary = strings.join(shared, "term_key", "left_anti").select("term_key", F.lit("").alias("split"), "term")
        split_terms = again.select("term_key", "split").distinct()
        dictionary = dictionary.unionByName(split_terms.select("term_key", "split", F.col("split").alias("term")))

    # Totals, sizes of vocabularies, and each source's place among those of its language.
    term = ["lang_key", "term_key", "split"]
    entries_ = counts.select("lang_key", "group_key", "term_key", "split", "n").join(kept, term)
    entries_ = cut_lineage(entries_, "entries")
    sizes = kept.groupBy("lang_key").agg(F.count(F.lit(1)).alias("vocabulary"), F.sum("lang_n").alias("lang_total"))
    totals = entries_.groupBy("group_key").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("lang_key").orderBy("source")) - 1
    stats = groups.join(sizes, "lang_key", "left").join(totals, "group_key", "left").withColumn("place", place)
    zero = F.lit(0).cast("long")
    stats = stats.select("lang", "source", "lang_key", "group_key", "place", *[F.coalesce(F.col(c), zero).alias(c) for c in ("vocabulary", "lang_total", "total")])
    stats = stats.withColumn("base", _share(zero, F.col("total"), F.col("vocabulary"), smooth, scale))
    stats = cut_lineage(stats, "groups-with-totals")
    numbers = stats.select("group_key", "place", "total", "vocabulary", "lang_total")
    shares = entries_.join(numbers, "group_key").select(
        *term, "group_key", "place",
        _share(F.col("n"), F.col("total"), F.col("vocabulary"), smooth, scale).alias("p"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("vocabulary"), smooth, scale).alias("q"),
    )

    # Terms: the best by value alone (ties at the last rank stay), then strings, then the exact rank.
    by_value = Window.partitionBy("group_key").orderBy(F.desc("value"))
    best = shares.where(F.col("p") > F.col("q")).select("group_key", "term_key", "split", (F.col("p") - F.col("q")).alias("value"))
    best = best.withColumn("near", F.rank().over(by_value)).where(F.col("near") <= ranks)
    best = best.join(dictionary, ["term_key", "split"]).join(stats.select("group_key", "lang", "source"), "group_key")
    exact = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    best = best.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value").withColumn("rank", exact)
    best = best.where(F.col("rank") <= ranks)

    # Pairs: per term one row of its sources' shares (per two blocks, where a language has many sources), summed within the tasks.
    blocks = stats.withColumn("i", F.floor(F.col("place") / block).cast("int"))
    blocks = blocks.groupBy("lang_key", "i").agg(F.sort_array(F.collect_list(F.struct("place", "base"))).alias("sources"))
    blocks = blocks.select("lang_key", "i", F.col("sources.base").alias("base"))
    two = blocks.select("lang_key", "i", F.col("base").alias("base_i")).join(
        blocks.select("lang_key", F.col("i").alias("j"), F.col("base").alias("base_j")), "lang_key"
    ).where(F.col("i") <= F.col("j"))
    placed = F.struct((F.col("place") % block).cast("int").alias("at"), F.col("p").alias("p"))
    listed = shares.groupBy(*term).agg(F.collect_list(F.struct(F.floor(F.col("place") / block).cast("int").alias("i"), placed.alias("share"))).alias("all"))

    def side(name: str) -> Column:
        return F.transform(F.filter("all", lambda s: s["i"] == F.col(name)), lambda s: s["share"])

    rows = listed.join(two, "lang_key").select("lang_key", "i", "j", "base_i", "base_j", side("i").alias("left"), side("j").alias("right"))
    sums = rows.sortWithinPartitions("lang_key", "i", "j").mapInArrow(_pair_sums, "lang_key long, i int, j int, a int, b int, value long")
    sums = sums.select("lang_key", (F.col("i") * block + F.col("a")).alias("one"), (F.col("j") * block + F.col("b")).alias("other"), "value")
    # A block with itself gives both directions already.
    both = F.explode(F.when(F.floor(F.col("one") / block) == F.floor(F.col("other") / block), F.array(F.struct("one", "other")))
                     .otherwise(F.array(F.struct("one", "other"), F.struct(F.col("other").alias("one"), F.col("one").alias("other")))))
    sums = sums.groupBy("lang_key", "one", "other").agg(F.sum("value").alias("value")).withColumn("both", both)
    sums = sums.select("lang_key", F.col("both.one").alias("one"), F.col("both.other").alias("other"), "value")
    one = stats.select("lang_key", "lang", "source", F.col("place").alias("one"))
    other = stats.select("lang_key", F.col("source").alias("item"), F.col("place").alias("other"))
    pairs = one.join(other, "lang_key").where(F.col("one") != F.col("other")).join(sums, ["lang_key", "one", "other"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", zero).alias("value")).withColumn("rank", exact)
    return pairs.unionByName(best)
