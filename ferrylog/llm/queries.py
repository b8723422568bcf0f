"""The registered queries of the training-data operators, and those that SQL can express as SQL."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrylog.llm import (
    embedding_forest,
    exact,
    hard_negatives,
    langid,
    mixing,
    ngram_join,
    ordinal_quality,
    piece_codec,
    pseudonyms,
    tag_paths,
    token_counts,
    toxicity,
    whitening,
)
from ferrylog.staging import new_folder

TOKENIZERS = os.environ.get("TOKENIZER_FOLDER") or os.path.dirname(public_tokenizers.path("piece_bpe_32k.model"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxic in English, then in another language, where the offensive words are others, and from both: toxic at all."""
    toxic, english = F.col("toxic") == 1, F.coalesce(F.col("lang") == "en", F.lit(False))
    categories = {"toxic_en": toxic & english, "toxic_other": toxic & ~english, "toxic": toxic}
    docs = table(spark, folder, "documents")
    chain = toxicity.fit(docs, table(spark, folder, "labels"), categories, drawn_by="toxic")
    return toxicity.score(docs, chain, list(categories), flag="toxic")


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Four-word shingles that overlap to 85 in 100; classes and numbers of links."""
    return ngram_join.link_counts(table(spark, folder, "documents"), ngram_join.Rule(words=4, num=85, den=100))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rows = langid.identify(docs, langid.fit(docs))
    return rows.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.dedup(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Each run begins with an empty cache of its own, so all distinct texts are encoded."""
    cache = new_folder(spark, "token-cache")
    return token_counts.count_tokens(table(spark, folder, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", cache)


def op6_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed key, so that reruns agree; a real run takes its own."""
    rows = pseudonyms.hide(table(spark, folder, "documents"), b"key of the test tables")
    return rows.select("doc_id", "text", "values", F.size("values").alias("n_values"))


def op7_embedding_forest(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_forest.link_vectors(table(spark, folder, "embeddings"), cosine=0.95)


def op8_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Grade 0: low quality; 1: good but toxic; 2: good and clean. Selected are texts that are likely good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
    docs = table(spark, folder, "documents")
    model = ordinal_quality.fit(docs, table(spark, folder, "labels"), grade, 2)
    return ordinal_quality.score(docs, model, 1)


def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.shares(table(spark, folder, "documents"))
    return rows.selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken", "copies")


def op10_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    model = piece_codec.read_model(f"{TOKENIZERS}/piece_bpe_32k.model")
    return piece_codec.encode(table(spark, folder, "documents"), model, as_trained=True).drop("ids")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the vectors whose id is divisible by 50; ids divisible by 7 carry a wrong label, as noise."""
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", noisy)
    rows = hard_negatives.mine(vectors, F.col("vec_id") % 50 == 0)
    return rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_tag_paths(spark: SparkSession, folder: str) -> DataFrame:
    return tag_paths.extract(table(spark, folder, "pages"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_ngram_join": op2_ngram_join,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_pseudonyms": op6_pseudonyms,
    "op7_embedding_forest": op7_embedding_forest,
    "op8_ordinal_quality": op8_ordinal_quality,
    "op9_mix_sources": op9_mix_sources,
    "op10_piece_codec": op10_piece_codec,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_tag_paths": op13_tag_paths,
}

EXACT_SQL = r"""
WITH named AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM {docs}
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER best AND n_chars = first_value(n_chars) OVER best AS kept, sha256(norm) AS text_sha256, n_chars
FROM named
WINDOW best AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""

# the level of the water is that of the first source that needs no stop
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM {docs}
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][place % 3 + 1] AS w, 3 * source_size AS cap,
         ((place * 2654435761 + 20) % 4294967296 % 1024 + 0.5) / 1024 AS offs
  FROM sources
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), fixed AS (
  SELECT min_by(level, cap / w) AS level FROM levels WHERE cap >= w * level
), goals AS (
  SELECT source, source_size, offs, CASE WHEN l.cap / l.w < f.level THEN CAST(l.cap AS DOUBLE)
         ELSE least(l.w * f.level, CAST(l.cap AS DOUBLE)) END AS target
  FROM levels l CROSS JOIN fixed f
), ranked AS (
  SELECT s.*, g.source_size, g.target, g.offs,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS share,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) AS n
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), counted AS (
  SELECT *, CAST(least(floor(n * share + offs) - floor((n - 1) * share + offs), 3) AS BIGINT) AS copies FROM ranked
)
"""

# every anchor against every row
MINE_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: coalesce(isfinite(c), false))) = len(embedding)
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.x) = len(b.x)
), positives AS (
  SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id NULLS LAST) AS place
  FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
   AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 3
"""

ORACLE = {
    "op11_hard_negatives": MINE_SQL,
    "op4_exact_dedup": EXACT_SQL.format(docs="documents"),
    "op9_mix_sources": MIX_SQL.format(docs="documents")
    + "SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM counted",
}
