"""Registered queries over the given tables, and their DuckDB SQL.

``QUERIES`` and ``ORACLES`` are read by the entry module; nothing else in the
library imports them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatlane.llm import (
    chat_format, hard_negatives, lexical_search, license_scan, line_dedup, mixing, near_dedup, oracles, packing, quality, secret_scan,
    substring_dedup, token_counts, topk_search,
)
from heatlane.session import durable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


@query("op7_line_dedup", oracles.LINE_DEDUP)
def op7(spark, sf):
    out = line_dedup.dedup_lines(_documents(spark, sf))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op8_quality_rules", oracles.QUALITY)
def op8(spark, sf):
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judge(_documents(spark, sf)).select("row.doc_id", *counts, "lost_chars", "base_failed", "kept")


@query("op1_secret_scan", oracles.SECRETS)
def op1(spark, sf):
    found = secret_scan.scan(_documents(spark, sf)).select("row.doc_id", "spans")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(secret_scan.BASE))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(secret_scan.BASE)],
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"), secret_scan.span_text(F.col("spans")).alias("spans"),
    )


@query("op10_license_scan", oracles.LICENSES)
def op10(spark, sf):
    found = license_scan.find_licenses(_documents(spark, sf)).select("row.doc_id", "matches")
    best = F.array_max(F.transform("matches", lambda m: F.struct(m["dice"].alias("dice"), m["license"].alias("license"))))
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        best["license"].alias("best"), best["dice"].alias("dice"),
    )


@query("op3_mix_sources", oracles.MIX)
def op3(spark, sf):
    docs = _documents(spark, sf)
    return mixing.mix(docs).select("row.*", F.col("copy").cast("long").alias("copy"), F.round("rate", 9).alias("rate"))


@query("op2_best_fit_packing")
def op2(spark, sf):
    return packing.pack(packing.cut(_documents(spark, sf)))


@query("op6_simhash_near_dedup")
def op6(spark, sf):
    return near_dedup.near_duplicates(_documents(spark, sf))


@query("op5_substring_dedup")
def op5(spark, sf):
    return substring_dedup.remove_repeats(_documents(spark, sf), digest=True).withColumnRenamed("kept", "kept_sha256")


@query("op4_topk_search", oracles.TOP_K)
def op4(spark, sf):
    vectors = durable(topk_search.quantised(spark.read.parquet(f"{sf}/embeddings.parquet")), "vectors")
    return topk_search.top_k(vectors, vectors.filter(topk_search.is_query()))


@query("op9_token_counts")
def op9(spark, sf):
    return token_counts.count_tokens(_documents(spark, sf))


@query("op11_lexical_search", oracles.LEXICAL)
def op11(spark, sf):
    return lexical_search.rank_documents(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


@query("op12_chat_format", oracles.CHAT)
def op12(spark, sf):
    given = spark.read.parquet(f"{sf}/conversations.parquet")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.expand(given.select(*more.columns).unionByName(more)))


@query("op13_hard_negatives", oracles.HARD_NEGATIVES)
def op13(spark, sf):
    given = spark.read.parquet(f"{sf}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = durable(hard_negatives.labelled(given.withColumn("label", moved)), "labelled")
    return hard_negatives.mine(rows, rows.filter(F.col("vec_id") % hard_negatives.EVERY == 0))
