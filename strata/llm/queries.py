"""The registered queries of the training-data operators and their DuckDB twins.

Each query applies one operator with production parameters to its whole table;
``queries`` and ``oracles`` are added by ``__spark_entry__.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    bit_clusters,
    chat,
    divergence,
    exact_dedup,
    mixing,
    ngram_join,
    packing,
    quality,
    repair,
    speculative_bpe,
    suffix_dedup,
    syncmers,
    toxicity,
)
from strata.llm.common import ship, table
from strata.llm.tokens import vocabulary_path
from strata.session import cut_lineage


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats all conversations and a planted one of another layout, and reads them back."""
    ship(spark)
    turns = chat.canonical_turns(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), "conv_id")
    planted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, planted, planted)], "conv_id long, prompt string, completion string")
    turns = turns.unionByName(chat.canonical_turns(extra, "conv_id"))
    return chat.conversation_digests(chat.format_turns(turns))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_neighbours(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(docs, quality.training_labels(table(spark, sf_dir, "labels")), "quality")
    scored = quality.score(docs, model, ["doc_id"])
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "source", mixing.word_count("text").alias("size"))
    mixed = mixing.mix(cut_lineage(docs, "sizes"), size=F.col("size"))
    return mixed.select(
        "doc_id", "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__taken").alias("taken")
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.fit(docs, quality.training_labels(table(spark, sf_dir, "labels")), "toxic")
    scored = toxicity.score(docs, model, ["doc_id"])
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"), "neighbours", "cosines")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.token_files(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"), end=0)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"), end=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(documents(spark, sf_dir))


def op11_bit_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = bit_clusters.cluster(table(spark, sf_dir, "embeddings"))
    centroid = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", centroid.alias("centroid_sha256"))


def op12_speculative_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary_path("byte_bpe_50k.json")
    both = speculative_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), path, decoded="decoded")
    n_tokens = (F.octet_length("ids") / 4).cast("long")
    return both.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_suffix_dedup,
        op3_syncmers,
        op4_quality,
        op5_source_mix,
        op6_toxicity,
        op7_token_files,
        op8_packing,
        op9_exact_dedup,
        op10_ngram_join,
        op11_bit_clusters,
        op12_speculative_bpe,
        op13_source_divergence,
    )
}

#: DuckDB twins; the other operators are tested against brute force, round trips or held-out labels.
ORACLES: dict[str, str] = {
    "op1_chat_format": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), named AS (
  SELECT conv_id, turn, text,
         CASE lower(role) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' WHEN 'model' THEN 'assistant' ELSE role END AS role
  FROM turns
), escaped AS (
  SELECT *, length(regexp_replace(text, '(\\|</?s>|\[/?(?:INST|SYS|OUT|ROLE)[\] ])', '\\\1', 'g')) AS n,
         length(regexp_replace(role, '(\\|</?s>|\[/?(?:INST|SYS|OUT|ROLE)[\] ])', '\\\1', 'g')) AS r
  FROM named
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 9 WHEN 'system' THEN 11 ELSE 14 + r + length(r::VARCHAR) END)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id""",
    "op5_source_mix": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
weighted AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         3 * source_size AS cap
  FROM totals
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)
), water AS (SELECT *, max(CASE WHEN level * weight <= cap THEN level END) OVER () AS l FROM levels),
quota AS (
  SELECT source, source_size, CASE WHEN l IS NULL OR cap <= l * weight THEN cap::DOUBLE ELSE l * weight END AS target FROM water
), placed AS (
  SELECT d.*, q.source_size, q.target, floor(q.target)::BIGINT AS budget,
         (sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS before
  FROM d JOIN quota q ON d.source IS NOT DISTINCT FROM q.source
), epochs AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS e FROM placed)
SELECT doc_id, size, source_size, target,
       (e * size + greatest(0, least(size, budget - e * source_size - before)))::BIGINT AS taken
FROM epochs""",
    "op9_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
), g AS (
  SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256, doc_id) AS copy
  FROM d
)
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND copy = 1) AS kept, text_sha256 FROM g""",
    "op13_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), g AS (SELECT DISTINCT lang, source FROM d),
t AS (
  SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(o.total, 0) + 5 * s.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (s.total + 5 * s.v) AS q
  FROM g JOIN kept k USING (lang) JOIN size s USING (lang) LEFT JOIN totals o USING (lang, source) LEFT JOIN c USING (lang, source, term)
), sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, part, item, value::BIGINT AS value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
  FROM every
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
}

_INTS = "list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT)"
_ROUND = """r{n} AS MATERIALIZED (
  SELECT id, v, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
    SELECT r.id, r.v, k.c, list_sum(list_transform(list_zip(r.v, k.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept r, c{n} k
  ) GROUP BY id, v
), """
_MOVE = """m{n} AS (
  SELECT c, list((s - ((s % k) + k) % k) // k ORDER BY i)::BIGINT[] AS w FROM (
    SELECT cluster AS c, i, sum(v[i])::HUGEINT AS s, count(*)::HUGEINT AS k FROM r{n}, range(1, 65) t(i) GROUP BY cluster, i
  ) GROUP BY c
), c{after} AS MATERIALIZED (SELECT c{n}.c, coalesce(m{n}.w, c{n}.w) AS w FROM c{n} LEFT JOIN m{n} USING (c)), """
ORACLES["op11_bit_clusters"] = (
    f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, {_INTS} AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR), v) - 1)::INT AS c, v AS w FROM kept
  ORDER BY sha256('3:' || vec_id::VARCHAR), v LIMIT 8
), """
    + "".join(_ROUND.format(n=n) + _MOVE.format(n=n, after=n + 1) for n in range(bit_clusters.ROUNDS))
    + _ROUND.format(n=bit_clusters.ROUNDS).rstrip(", ")
    + """
SELECT kept.vec_id, r.cluster, r.distance, sum(r.distance) OVER (PARTITION BY r.cluster)::BIGINT AS cluster_inertia,
       sum(r.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(k.w, ',')) AS centroid_sha256
FROM r{n} r JOIN kept USING (id) JOIN c{n} k ON k.c = r.cluster""".format(n=bit_clusters.ROUNDS)
)
