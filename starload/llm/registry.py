"""Every operator of this subpackage as a query over its whole table: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from starload.llm import (
    ann,
    bpe,
    chat,
    langid,
    lexical,
    linededup,
    mixing,
    periodic,
    quality,
    secret_scan,
    sharding,
    simhash,
    urlfilter,
)
from starload.llm.common import table


# Read by the driver only.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.col("spans")
    base = secret_scan.joined(secret_scan.of_kind(spans, *secret_scan.BASE))
    return secret_scan.scan(table(spark, folder, "documents"), ["doc_id"]).select(
        "doc_id",
        *[F.size(secret_scan.of_kind(spans, k)).cast("long").alias(f"n_{k}") for k in secret_scan.BASE],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.joined(spans).alias("spans"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).withColumn("rate", F.round("rate", 6))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_removed_lines",
        "removed_chars",
        "depleted",
    )


def op4_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    named = langid.identify(docs, langid.learn(docs), ["doc_id"])
    return named.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", F.size("runs").alias("n_runs"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe.encode_documents(table(spark, folder, "documents"), VOCABULARY, ["doc_id"])
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_ann(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.assign(sharding.sized(table(spark, folder, "documents")), "doc_id")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = linededup.dedupe_lines(table(spark, folder, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return found.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    pieces = chat.transcribed(table(spark, folder, "conversations"))
    found = chat.parse(pieces, chat.learned(pieces))
    return found.select("conv_id", "turn", "role", "n_lines", "rendered")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.judge(table(spark, folder, "pages"), urlfilter.rule_table(spark), ["page_id"])


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(lexical.build(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.runs(periodic.with_tails(table(spark, folder, "documents")), ["doc_id"])
    best = F.col("best")
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_mixing": op2_mixing,
        "op3_quality": op3_quality,
        "op4_langid": op4_langid,
        "op5_bpe": op5_bpe,
        "op6_ann": op6_ann,
        "op7_sharding": op7_sharding,
        "op8_line_dedup": op8_line_dedup,
        "op9_chat": op9_chat,
        "op10_simhash": op10_simhash,
        "op11_url_filter": op11_url_filter,
        "op12_ranked_search": op12_ranked_search,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracles() -> dict[str, str]:
    return {
        "op1_secret_scan": secret_scan.ORACLE,
        "op2_mixing": mixing.ORACLE,
        "op3_quality": quality.ORACLE,
        "op8_line_dedup": linededup.ORACLE,
        "op11_url_filter": urlfilter.ORACLE,
        "op12_ranked_search": lexical.ORACLE,
    }
