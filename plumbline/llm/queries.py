"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op5_packing")
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from plumbline.llm.packing import pack

    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


@query("op7_quality")
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.quality import FEATURES, verdicts

    return verdicts(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", *FEATURES, "base_failed", "kept", "posterior")


@query("op8_jaccard")
def op8_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.jaccard import join_similar

    return join_similar(table(spark, folder, "documents"))


@query("op10_language_model")
def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from plumbline.llm.lm import fold, score, train

    docs = table(spark, folder, "documents").withColumn("held_out", fold(F.col("doc_id")) == 1)
    model = train(docs.where(~F.col("held_out")), order=2)
    return score(docs, model, "doc_id", "held_out").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


@query("op9_embeddings")
def op9_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.neighbors import near_duplicates

    return near_duplicates(table(spark, folder, "embeddings"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from plumbline.llm.lm import fold
    from plumbline.llm.toxicity import scored, train

    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", fold(F.col("doc_id")) == 0)
    labels = table(spark, folder, "labels").where(fold(F.col("doc_id")) != 0).select("doc_id", "toxic")
    model = train(docs, labels)
    return scored(docs, model, "doc_id", "held_out").select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_personal_data")
def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from plumbline.llm.pii import KINDS, detect

    return detect(table(spark, folder, "documents"), "doc_id").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", F.col("listed").alias("spans"),
        F.expr("size(filter(spans, s -> not s.base))").cast("long").alias("n_added"))


@query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from plumbline.llm.pieces import round_trip

    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), "doc_id")


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from plumbline.llm.wordpiece import build, count_pieces, sentencepiece_vocabulary

    pieces = sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    auto = build(pieces, start="▁".encode())
    return count_pieces(table(spark, folder, "documents"), auto, "doc_id")


@query("op3_quote_linking")
def op3_quote_linking(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.quoting import link_quotes

    return link_quotes(table(spark, folder, "conversations"))


@query("op11_hard_negatives", """
    WITH own AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    met AS (
        SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same, list_dot_product(a.v, o.v)::BIGINT AS score
        FROM own a JOIN own o ON a.vec_id <> o.vec_id WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM met WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN met USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql import functions as F

    from plumbline.llm.negatives import mine

    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    from plumbline.llm.whitening import whiten

    return whiten(table(spark, folder, "embeddings"))


@query("op13_byte_pairs")
def op13_byte_pairs(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from plumbline.llm.bytepairs import round_trip

    return round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "doc_id")
