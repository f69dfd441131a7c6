"""The registered queries of the operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bytesift.llm import (
    chat, fingerprints, fmindex, html, jaccard, mixing, negatives, oracles, packing, quality, rules, runs, suffixes, toxicity,
)
from bytesift.llm.store import WORD, documents


def op1_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(documents(spark, sf_dir))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# A conversation that holds the template's own marks.
MARKED = "\\### Assistant: </turn> ok"


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    marked = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], turns.schema)
    return chat.digests(chat.format_turns(turns.unionByName(marked)))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(documents(spark, sf_dir)))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    vectors = quality.word_vectors(docs)
    return quality.score(docs, vectors, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), vectors))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per maximal repeated span, with its document."""
    return suffixes.repeated_spans(documents(spark, sf_dir)).drop("drops")


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id with its word count, bucket, batch, slot and padding."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    sized = docs.select("doc_id", packing.word_count().alias("_words"))
    packed, _ = packing.pack(sized, F.col("_words"), F.col("doc_id"))
    return packed.drop("_words")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, the labels of every seventh moved on by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", "embedding", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label")
    )
    return negatives.hard_negatives(rows, "vec_id % 50 = 0")


def op12_copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document that no earlier document has in a window, as a digest."""
    return fmindex.without_copied_words(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def periodised(docs: DataFrame) -> DataFrame:
    """doc_id and text, the words of about every tenth document repeating from a place on
    with a period, both taken from the CRC-32 of its id."""
    words = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.expr("crc32(CAST(CAST(doc_id AS BIGINT) AS STRING))").alias("_h")
    ).select(
        "doc_id", "text", F.expr("_h DIV 10").alias("_g"),
        F.when(F.expr("_h % 10 = 0"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("_words"),
    )
    placed = words.withColumn("_a", F.expr("IF(size(_words) > 0, _g % size(_words), NULL)"))
    placed = placed.withColumn("_p", F.expr("1 + (size(_words) - _a) DIV (3 + _g % 8)"))
    made = (
        "array_join(transform(sequence(0, size(_words) - 1),"
        " i -> element_at(_words, int(1 + IF(i < _a, i, _a + (i - _a) % _p)))), ' ')"
    )
    return placed.select("doc_id", F.expr(f"IF(_a IS NULL, text, {made})").alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Number, strongest one and digests of the runs of the periodised texts."""
    found = runs.periodic_runs(periodised(docs)).withColumn("best", runs.strongest("runs"))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rules": op1_rules,
    "op2_chat": op2_chat,
    "op3_mix": op3_mix,
    "op4_jaccard": op4_jaccard,
    "op5_toxicity": op5_toxicity,
    "op6_fingerprints": op6_fingerprints,
    "op7_pack": op7_pack,
    "op8_quality": op8_quality,
    "op9_html": op9_html,
    "op10_repeats": op10_repeats,
    "op11_negatives": op11_negatives,
    "op12_copied": op12_copied,
    "op13_runs": op13_runs,
}

ORACLES: dict[str, str] = {
    "op1_rules": oracles.OP1_SQL,
    "op2_chat": oracles.OP2_SQL,
    "op4_jaccard": oracles.OP4_SQL,
    "op10_repeats": oracles.OP10_SQL,
    "op11_negatives": oracles.OP11_SQL,
    "op12_copied": oracles.OP12_SQL,
}
