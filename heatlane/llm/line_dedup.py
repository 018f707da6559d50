"""Line dedup: lines that many documents share stay in one document only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import ascii_lower, column, strip, text_of, whole_row, wide_hash, with_text
from heatlane.session import durable

MIN_CHARS, MIN_DOCS = 40, 5


def _keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough: document, text hash, position, hash of the key."""
    text = text_of(text_col)
    lines = docs.select(
        column(id_col).alias("doc"), F.xxhash64(text).alias("body"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line")
    ).select("doc", "body", "pos", ascii_lower(strip(F.col("line"))).alias("key"))
    h1, h2 = wide_hash(F.col("key"))
    return lines.filter(F.length("key") >= min_chars).select("doc", "body", "pos", h1.alias("h1"), h2.alias("h2"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Columns ``row`` (all columns but the text), ``text``, ``n_lines``, ``n_dropped``; one row per input row.

    A line's key is the line without white space at its ends and with A-Z in
    lower case. Keys of at least ``min_chars`` characters found in at least
    ``min_docs`` documents lose all their lines except in the largest id.

    Null or empty text: one empty line, never dropped. Rows of one id are one
    document for the count, and the surviving document keeps all its copies of
    the line. A null id counts as one document below all others. An empty table
    gives an empty result.

    Only hashes and positions are exploded and shuffled by key, in a join that can
    split a line of very many documents; texts move once,
    by document, and are put together from slices between dropped positions.
    """
    lines = durable(_keyed_lines(docs, id_col, text_col, min_chars), "lines")
    shared = (
        lines.select("h1", "h2", "doc").distinct()
        .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"))
        .filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper")
    )
    shared = durable(shared, "shared")  # both sides of the join come from files, so Spark can split a hot line
    drops = (
        lines.join(shared, ["h1", "h2"]).filter(~F.col("doc").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("doc").alias("d"), F.col("body").alias("b")).agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    )
    text = text_of(text_col)
    whole = docs.select(
        column(id_col).alias("doc"), F.xxhash64(text).alias("body"), whole_row(docs, text_col), F.split(text, "\n", -1).alias("lines")
    )
    joined = whole.join(drops, F.col("doc").eqNullSafe(F.col("d")) & (F.col("body") == F.col("b")), "left").select(
        "row", "lines", F.coalesce("drops", F.array().cast("array<int>")).alias("drops")
    )
    starts, ends = F.concat(F.array(F.lit(-1)), F.col("drops")), F.concat(F.col("drops"), F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(starts, ends, lambda s, e: F.slice(F.col("lines"), s + 2, e - s - 1)))
    return joined.select(
        "row", F.array_join(kept, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"), F.size("drops").cast("long").alias("n_dropped"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents with what is left of their texts."""
    return with_text(dedup_lines(docs), docs, "text", F.col("text"))
