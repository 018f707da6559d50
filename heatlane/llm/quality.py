"""Quality rules: clean line by line, then reject documents that lost too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import SPACES, squeezed, strip, text_of, whole_row, with_text, words_of

SYMBOLS = "#*$%&|<>"
SEPARATORS = "|<>»·•"
#: Phrases that mark a short line as page furniture.
FURNITURE = (
    r"(?i)\b(cookie policy|accept cookies|enable javascript|privacy policy|terms of use|terms of service|all rights reserved"
    r"|lorem ipsum|click here|sign up|log in|subscribe to|read more|share this|back to top|skip to content|page not found)\b"
)
FURNITURE_WORDS = 30
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOL_PERCENT, SHOUT_PERCENT, LOST_PERCENT = 10, 8, 50


def _count(c: Column, chars: str) -> Column:
    return F.length(c) - F.length(F.translate(c, chars, ""))


def bad_line(line: Column) -> Column:
    """Does a line fail a rule? A line without a word never does.

    Punctuation: no sentence mark at all, over a tenth symbols, or over 8 %
    exclamation marks. Navigation: three or more separators, at least one for
    six words. Boilerplate: a furniture phrase in a line of up to 30 words.
    """
    chars = F.length(squeezed(line))
    n_words = F.size(F.split(strip(line), r"[\x20\x09-\x0D]+", -1))
    bars = _count(line, SEPARATORS)
    punctuation = (
        ~line.rlike(r"[.!?:;…。！？]")
        | (_count(line, SYMBOLS) * 100 > chars * SYMBOL_PERCENT)
        | (_count(line, "!") * 100 > chars * SHOUT_PERCENT)
    )
    navigation = (bars >= 3) & (bars * 6 >= n_words)
    boilerplate = (n_words <= FURNITURE_WORDS) & line.rlike(FURNITURE)
    return (chars > 0) & (punctuation | navigation | boilerplate)


def _repeated_words(df: DataFrame, *carried: str) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a five-word window that the text
    holds twice or more. Windows are sorted by hash with their positions, so
    equal ones meet; covered words are then summed in order of position.
    Each select names an array at least twice or feeds an array to a lambda as
    a column, so that no array is worked out again per element."""
    hashes = df.select(*carried, F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = hashes.select(
        *carried,
        F.when(
            F.size("hashes") >= WINDOW,
            F.transform(
                F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(0))),
                lambda h, i: F.xxhash64(h, *[F.get(F.col("hashes"), i + k) for k in range(1, WINDOW)]),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    ordered = windows.select(
        *carried,
        F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none).alias("s"),
    )
    at = lambda i: F.get(F.col("s"), i)["h"]
    same = lambda x, i: F.coalesce(at(i - 1) == x["h"], F.lit(False)) | F.coalesce(at(i + 1) == x["h"], F.lit(False))
    places = ordered.select(*carried, F.sort_array(F.transform(F.filter("s", same), lambda x: x["i"])).alias("places"))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    step = lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"))
    return places.select(*carried, F.aggregate("places", start, step, lambda a: a["n"]).alias("n_repeat_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``row`` (all columns but the text), ``text`` (its
    lines that passed), ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``lost_chars``, ``kept``.

    A document is kept if it has at least 10 words, at most 20 % of them in
    repeated five-word windows, and lost at most half of its word characters
    with failing lines. Null or empty text: no words, so not kept. Ids may be
    null or repeat; each row is judged alone. An empty table stays empty.
    No shuffle: everything happens within the row.
    """
    text = text_of(text_col)
    first = docs.select(whole_row(docs, text_col), text.alias("text")).select(
        "row", "text", words_of(F.col("text")).alias("words"), F.split("text", "\n", -1).alias("lines")
    )
    counted = first.select(
        "row", "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        F.filter("lines", lambda line: F.length(strip(line)) > 0).alias("live"),
        F.array_join(F.filter("lines", lambda line: ~bad_line(line)), "\n").alias("clean"),
    ).select(
        "row", "words", "n_words", "word_chars", "n_symbols", "clean",
        (F.size("live") - F.size(F.array_distinct("live"))).cast("long").alias("n_dup_lines"),
        (F.col("word_chars") - F.length(squeezed(F.col("clean")))).cast("long").alias("lost_chars"),
    )
    all_counts = _repeated_words(counted, "row", "clean", "n_words", "word_chars", "n_symbols", "n_dup_lines", "lost_chars")
    # A filter on the result must not be pushed below: Catalyst would write the whole chain of arrays into its
    # condition and work it out again per element. A column that isn't deterministic keeps it above.
    stay = F.spark_partition_id() >= 0
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return all_counts.select(
        "row", F.col("clean").alias("text"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars",
        failed.alias("base_failed"),
        (stay & ~failed & (F.col("lost_chars") * 100 <= F.col("word_chars") * LOST_PERCENT)).alias("kept"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: kept documents with the lines that passed."""
    return with_text(judge(docs).filter("kept"), docs, "text", F.col("text"))
