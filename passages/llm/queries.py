"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passages.llm.covertree import top_scores
from passages.llm.decontaminate import contained_items
from passages.llm.filters import audit_filters
from passages.llm.jaccard import similar_sets
from passages.llm.lexical import ranked_search
from passages.llm.licenses import license_scan
from passages.llm.mixing import mix_sources
from passages.llm.packing import pack_documents
from passages.llm.quality import score_quality, train_quality
from passages.llm.repeats import drop_repeats
from passages.llm.secrets import secret_scan
from passages.llm.sharding import TABLE_SLOTS, fill_table, place
from passages.llm.wordpiece import token_counts

SHARDS = [f"shard-{i:03d}" for i in range(64)]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan(table(spark, sf, "documents"))


def op2_top_scores(spark: SparkSession, sf: str) -> DataFrame:
    return top_scores(table(spark, sf, "embeddings"), every=50, k=5)


def op3_drop_repeats(spark: SparkSession, sf: str) -> DataFrame:
    return drop_repeats(table(spark, sf, "documents"))


def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    return score_quality(documents, train_quality(documents, table(spark, sf, "labels")))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(table(spark, sf, "documents"), tokenizer_path())


def op6_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"), tokenizer_path())


def op7_contained_items(spark: SparkSession, sf: str) -> DataFrame:
    return contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_similar_sets(spark: SparkSession, sf: str) -> DataFrame:
    return similar_sets(table(spark, sf, "documents"))


def op9_shards(spark: SparkSession, sf: str) -> DataFrame:
    return place(table(spark, sf, "documents"), "doc_id", SHARDS)


def op10_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan(table(spark, sf, "documents"))


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit_filters(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op12_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mix_sources(table(spark, sf, "documents"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_top_scores": op2_top_scores,
    "op3_drop_repeats": op3_drop_repeats,
    "op4_quality": op4_quality,
    "op5_token_counts": op5_token_counts,
    "op6_packing": op6_packing,
    "op7_contained_items": op7_contained_items,
    "op8_similar_sets": op8_similar_sets,
    "op9_shards": op9_shards,
    "op10_secret_scan": op10_secret_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_lexical_search": op12_lexical_search,
    "op13_source_mix": op13_source_mix,
    "pipeline": pipeline,
}

# SQL that does not use the operators, where SQL can express them on whole tables.
_owners = ",".join(map(str, fill_table(SHARDS, TABLE_SLOTS)))
ORACLES = {
    "op2_top_scores": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id,
         list_dot_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
    "op7_contained_items": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t-\r]+'), lambda w: w <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t-\r]+'), lambda w: w <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), bs AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS width, unnest(
    list_transform(range(1, len(w) - least(len(w), 5) + 2),
                   lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS s
  FROM b WHERE len(w) > 0
), n AS (
  SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id
), ds AS (
  SELECT DISTINCT doc_id, unnest(
    list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM d WHERE len(w) >= 5
), hits AS (
  SELECT doc_id, item_id, count(*) AS n_shared
  FROM ds JOIN bs USING (s) WHERE width = 5 GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM hits JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_shingles
""",
    "op9_shards": f"""
WITH o AS (SELECT string_split('{_owners}', ',') AS owners),
p AS (
  SELECT *,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {TABLE_SLOTS} AS slot
  FROM documents
)
SELECT p.*,
       'shard-' || lpad(owners[slot + 1], 3, '0') AS shard
FROM p, o
""",
    "op11_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda w: w <> '') AS w
  FROM documents
), l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good,
         coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), m AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(w) < 100,
    'B': 100 * len(list_distinct(w)) < 80 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'),
    'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)} AS f
  FROM d LEFT JOIN l USING (doc_id)
), x AS (
  SELECT part, good, toxic, f.A::INT + 2 * f.B::INT + 4 * f.C::INT + 8 * f.D::INT + 16 * f.E::INT AS failed
  FROM m
), c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM x GROUP BY part, failed
), b AS (SELECT unnest(range(5)) AS i), o AS (
  SELECT [b1.i, b2.i, b3.i, b4.i, b5.i] AS places
  FROM b b1, b b2, b b3, b b4, b b5
  WHERE len(list_distinct([b1.i, b2.i, b3.i, b4.i, b5.i])) = 5
), s AS (
  SELECT array_to_string(list_transform(places, lambda i: 'ABCDE'[i + 1]), '') AS filter_order,
         k::INT AS step,
         coalesce(list_sum(list_transform(places[1:k - 1], lambda i: (1 << i)::INT)), 0)::INT AS earlier,
         (1 << places[k])::INT AS own
  FROM o, (SELECT unnest(range(1, 6)) AS k)
), r AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER ((failed & (earlier | own)) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER ((failed & own) > 0 AND (failed & earlier) = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER ((failed & own) > 0 AND (failed & earlier) > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (failed = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER ((failed & own) > 0 AND (failed & earlier) = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER ((failed & own) > 0 AND (failed & earlier) = 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, own
)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
""",
    "op12_lexical_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE doc_id IS NOT NULL
), b AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL
), a AS (
  SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d
), t AS (
  SELECT place, doc_id, len(w) AS n, unnest(w) AS term FROM d
), f AS (
  SELECT place, doc_id, n, term, count(*) AS tf FROM t
  WHERE term IN (SELECT term FROM b) GROUP BY place, doc_id, n, term
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM f, a GROUP BY term, n_docs
), s AS (
  SELECT item_id, place, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM b JOIN f USING (term) JOIN w USING (term), a GROUP BY item_id, place, doc_id
), r AS (
  SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank,
         doc_id, score
  FROM s WHERE score > 0
)
SELECT * FROM r WHERE rank <= 10
""",
}
