"""The registered queries opN_<name>: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (chat, decontam, html, lines, lm, mixing, quality, runs, search, shards,
                            simhash, tokens, toxicity)
from ledgerlake.llm.common import WORD, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "text", "line_counts.n_lines", "line_counts.n_removed")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7))
    scored = lm.score(table(spark, sf_dir, "documents"), fold != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                         F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


# The conversation the query adds.
EXTRA_TEXT = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", EXTRA_TEXT), (-1, 1, "assistant", EXTRA_TEXT)],
                                  rows.schema)
    return chat.read_back(chat.render(rows.unionByName(extra)))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return tokens.token_counts(table(spark, sf_dir, "documents"),
                               str(public_tokenizers.path("byte_bpe_50k.json")))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(table(spark, sf_dir, "documents").select("doc_id", "text"),
                          table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["hi"] - s["lo"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"))


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash.components(table(spark, sf_dir, "documents"))
    return c.select("doc_id", simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_usage(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where the words of each document with h % 10 = 0 end in a period.

    h is the crc32 of the id in decimals (null: the empty string), g = floor(h / 10); from word
    a = g % n on, the words repeat with period 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), F.lit(0))
    d = docs.select("doc_id", "text", h.alias("h"), F.expr("0L").alias("g"))
    d = d.withColumn("g", F.expr("h div 10")) \
        .withColumn("w", F.when(F.col("h") % 10 == 0, words)) \
        .withColumn("n", F.size("w")) \
        .withColumn("a", F.expr("if(n > 0, g % n, 0)")) \
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = F.expr("array_join(transform(sequence(0L, n - 1L), "
                     "i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return d.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text"))
                    .alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.word_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    lines_of = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines_of, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("query").alias("item_id"), "rank", "doc_id", "score")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = shards.shard_documents(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return d.select("doc_id", "size", "text_crc32", "law", "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_toxicity": op4_toxicity,
    "op5_chat_format": op5_chat_format,
    "op6_token_counts": op6_token_counts,
    "op7_decontamination": op7_decontamination,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_lexical_search": op12_lexical_search,
    "op13_sharding": op13_sharding,
}
