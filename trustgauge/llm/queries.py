"""The operators applied to the given tables, as named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgauge.llm import (
    chat,
    divergence,
    exactdup,
    htmltext,
    mixing,
    neardup,
    ordered,
    packing,
    quality,
    repair,
    sharding,
    substrings,
    urls,
)
from trustgauge.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]



def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """The public vocabulary that pieces are cut with."""
    import public_tokenizers

    return public_tokenizers.path(name)


# The conversation that carries control strings in its texts.
PLANTED = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    done = chat.chat_format(chat.message_tree(given.unionByName(planted)))
    read = done.select(
        "conv_id", "n_turns", "formatted",
        chat.parse_turns(F.col("formatted")).alias("turns"),
        chat.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# The query's own terms: shingles of three words, links from 0.85 on.
NEAR = neardup.Settings(shingle=3, percent=85)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(table(spark, sf_dir, "documents"), NEAR).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_groups(table(spark, sf_dir, "documents"))


# The query's rules, and the parts of host names that its labels are drawn from.
RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)
BAD_PARTS = "adult|bets|casino|pills|spam|ads"


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trees learn from labels that a list of bad host parts gives, on lexical features."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = pages.select(
        "url", urls.host_of(F.col("url")).rlike(rf"(^|[.-])({BAD_PARTS})([.-]|$)").cast("int").alias("bad")
    )
    model = urls.fit_urls(labelled)
    return urls.judge_urls(pages, model, RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.round("bad", 6).alias("bad")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf_dir, "pages")).select(
        "page_id", F.length("text").cast("long").alias("n_chars"), "text"
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer()).select(
        F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan_of(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), "taken"
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes(quality.BASE)).alias("base_failed"), "kept", "failed",
    )


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_words", "n_removed",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = repair.Repair(repair.damaged(given))
    every = given.select("conv_id").distinct().withColumn("key", repair.key_of("conv_id"))
    found = every.join(done.report(), "key", "left").join(done.digests(), "key", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(repair.EMPTY_SHA256)).alias("repaired_sha256"),
    )


def op12_ordered_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordered.pack_in_order(docs, tokenizer("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Query]:
    return {
        "op1_chat_format": op1_chat_format,
        "op2_minhash_near_dedup": op2_minhash_near_dedup,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_url_filters": op4_url_filters,
        "op5_sharding": op5_sharding,
        "op6_html_extraction": op6_html_extraction,
        "op7_best_fit_packing": op7_best_fit_packing,
        "op8_mixing": op8_mixing,
        "op9_quality_rules": op9_quality_rules,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_ordered_packing": op12_ordered_packing,
        "op13_source_divergence": op13_source_divergence,
    }
