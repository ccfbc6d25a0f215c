"""The registered queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txspark.llm import (
    bpe,
    cover_tree,
    factorisation,
    language_id,
    ngram_join,
    oracle,
    packing,
    periodic_runs,
    pii,
    quality_rules,
    secret_scan,
    sharding,
    toxicity,
    whitening,
)
from txspark.llm.common import held_out, once, read, stored
from txspark.llm.spans import literal

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    net = language_id.train(docs.where(~F.col("held_out")), "text", "lang", "doc_id")
    return docs.select(
        "doc_id", "held_out", language_id.predict(net, F.col("text")).alias("p")
    ).select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = read(spark, sf_dir, "documents").select("doc_id", bpe.encode(F.col("text"), ranks, pattern).alias("ids"))
    return ids.select("doc_id", "ids", bpe.decode(F.col("ids"), ranks, pattern).alias("decoded")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counted = quality_rules.histograms(quality_rules.base_counts(docs, "text")).drop("text")
    counted = stored(counted, "quality")
    refs = quality_rules.references(counted, "lang")
    return quality_rules.judge(counted, refs, quality_rules.Limits()).drop(
        "lang", "class_counts", "word_counts", "class_distance", "word_distance"
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


SEQUENCE_TOKENS = 2048


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS, added=True)


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op7_cover_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(read(spark, sf_dir, "embeddings"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labelled = secret_scan.findings(docs, "text", "source").select(F.explode("candidates").alias("x"))
    model = secret_scan.train(labelled.select("x", secret_scan.known_label().alias("label")))
    out = secret_scan.scan(docs, "text", "source", model)
    spelled = "array_join(transform(secrets, x -> concat(x.s, ':', x.e)), ',')"
    return out.select("doc_id", "n_candidates", "n_secrets", F.expr(spelled).alias("secrets"))


QUALITY_CUT = 0.7


def op9_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", held_out(F.col("doc_id")))
    labels = read(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    machine = factorisation.train(docs, labels, "text", "n_chars", "doc_id", "quality")
    scored = docs.select(
        "doc_id", "held_out", factorisation.score(machine, F.col("text"), F.col("n_chars")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = pii.train(docs, "text")
    out = pii.detect(docs.select("doc_id", "text"), "text", model)
    return out.select(
        "doc_id",
        *[f"n_{k}" for k in pii.KINDS],
        F.sha2("base_spans", 256).alias("base_sha256"),
        "spans",
    )


TOXIC_CUT = 0.7


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = read(spark, sf_dir, "documents").select("doc_id", held.alias("held_out"), "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels").where(~held), "text", "doc_id", "toxic")
    scored = docs.select("doc_id", "held_out", toxicity.score(model, F.col("text")).alias("x"))
    return scored.select("doc_id", "held_out", "x.score", (F.col("x.score") >= TOXIC_CUT).cast("int").alias("predicted"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = whitening.whitened(vectors, "embedding").select("vec_id", "whitening")
    return out.select("vec_id", "whitening", F.explode("whitening.components").alias("c")).select(
        "vec_id",
        "c.component",
        "whitening.n",
        "whitening.deviation",
        "c.whitened",
        "c.explained",
        "whitening.identity_error",
    )


def _with_planted_runs(doc_id: str, text: str) -> str:
    """SQL for the text in which every tenth document, by id hash, repeats a stretch of its words."""
    h, word = f"crc32(CAST({doc_id} AS STRING))", literal("[^\\x20\\x09-\\x0D]+")
    bound = f"transform(array(regexp_extract_all({text}, {word}, 0)), w -> struct(w AS w, size(w) AS n, {h} div 10 AS g))"
    spot = f"transform({bound}, x -> struct(x.w AS w, x.n AS n, x.g % x.n AS a, 3 + x.g % 8 AS k))"
    spot = f"transform({spot}, x -> struct(x.w AS w, x.n AS n, x.a AS a, 1 + (x.n - x.a) div x.k AS p))"
    taken = "IF(i < x.a, i, x.a + (i - x.a) % x.p)"
    moved = f"transform({spot}, x -> transform(sequence(0, x.n - 1), i -> element_at(x.w, CAST({taken} AS INT) + 1)))"
    return f"CASE WHEN {h} % 10 = 0 AND {text} RLIKE {word} THEN array_join(flatten({moved}), ' ') ELSE {text} END"


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    # a step of its own: Python functions do not take arguments that hold lambda functions
    docs = once(docs, planted=F.expr(_with_planted_runs("doc_id", "text")))
    found = docs.select("doc_id", periodic_runs.detect(F.col("planted")).alias("x"))
    spelled = "array_join(transform(x.runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))), '')"
    return found.select(
        "doc_id",
        F.size("x.runs").cast("long").alias("n_runs"),
        "x.strongest.start",
        "x.strongest.length",
        "x.strongest.period",
        F.expr("1000 * x.strongest.length div x.strongest.period").alias("exponent_milli"),
        F.expr(f"sha2({spelled}, 256)").alias("runs_sha256"),
        F.sha2("x.collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": op1_language_id,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_quality_rules": op3_quality_rules,
        "op4_sharding": op4_sharding,
        "op5_packing": op5_packing,
        "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
        "op7_cover_tree_dedup": op7_cover_tree_dedup,
        "op8_secret_scan": op8_secret_scan,
        "op9_factorisation_machine": op9_factorisation_machine,
        "op10_pii": op10_pii,
        "op11_toxicity": op11_toxicity,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
