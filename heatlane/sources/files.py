"""Table files: tolerant CSV scans, Parquet, versioned priors, samples."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatlane.sources import manifest

SOURCE = "__source_file"
JAPANESE = "cp932"


def _strings(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def file_heads(spark: SparkSession, folder: str) -> DataFrame:
    """(path, head, is_utf8) of the CSV files: the bytes of the first line, and
    whether all lines are valid UTF-8. Files are read line by line."""
    lines = spark.read.text(folder, pathGlobFilter="*.csv").select(
        F.col("_metadata.file_path").alias("path"), "value",
        F.struct(F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n")).alias("place"),
    )
    return lines.groupBy("path").agg(
        F.min_by(F.col("value").cast("binary"), "place").alias("head"), F.bool_and(F.is_valid_utf8("value")).alias("is_utf8")
    )


def header_groups(spark: SparkSession, folder: str) -> list[tuple[tuple[str, ...], bool, list[str]]]:
    """(header, is UTF-8, files) groups of the CSV files of a folder.

    The CSV source maps columns by position, so files with another header order
    are read apart. One short row per file travels to the driver, whose file
    index holds the paths anyway; the header goes through a CSV reader.
    """
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    for row in file_heads(spark, folder).collect():
        text = bytes(row["head"]).decode("utf-8" if row["is_utf8"] else JAPANESE).lstrip("\ufeff").rstrip("\r")
        groups.setdefault((tuple(next(csv.reader([text]))), row["is_utf8"]), []).append(row["path"])
    return sorted(((h, ok, sorted(paths)) for (h, ok), paths in groups.items()), key=lambda g: g[2][0])


def _japanese(raw: Column) -> Column:
    """Bytes of Windows Japanese text, which Spark's own decoders don't know."""

    def decode(values: pd.Series) -> pd.Series:
        return values.map(lambda b: None if b is None else bytes(b).decode(JAPANESE))

    return F.pandas_udf(decode, "string")(raw)


def _scan(spark: SparkSession, header: Sequence[str], utf8: bool, paths: list[str]) -> DataFrame:
    """Files of one header and charset. Japanese bytes are carried through the CSV
    reader as Latin-1, one character a byte, in which no comma, quote or line end
    can be part of a character."""
    reader = spark.read.schema(_strings(header)).option("header", True).option("enforceSchema", True).option("escape", '"')
    rows = reader.option("encoding", "UTF-8" if utf8 else "ISO-8859-1").csv(paths)
    rows = rows.select("*", F.col("_metadata.file_name").alias(SOURCE))
    if utf8:
        return rows
    return rows.withColumns({c: _japanese(F.encode(F.col(f"`{c}`"), "ISO-8859-1")) for c in header})


def _union(frames: list[DataFrame], folder: str) -> DataFrame:
    if not frames:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def scan_daily_csv(spark: SparkSession, folder: str, wanted: Sequence[str] | None = None) -> DataFrame:
    """Every CSV of a folder as text, empty cells kept as "", with the file name.

    Columns are matched by name across files; a column a file lacks is null.
    """
    frames = []
    for header, utf8, paths in header_groups(spark, folder):
        texts = {c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in header}
        frames.append(_scan(spark, header, utf8, paths).withColumns(texts))
    out = _union(frames, folder)
    if wanted is not None:
        out = scan_projected(out, [*wanted, SOURCE])
    return out


def scan_projected(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist; Catalyst prunes the scan."""
    return df.select(*[f"`{c}`" for c in wanted if c in df.columns])


def scan_csv_lenient(spark: SparkSession, folder: str) -> DataFrame:
    """UTF-8 files as they are, the others as Windows Japanese text; bad bytes
    decide per file, and each file's columns go by its own header."""
    return _union([_scan(spark, *group) for group in header_groups(spark, folder)], folder)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """CSV with a header; ``bom`` puts a byte order mark before it in each file."""
    first = df.columns[0]
    out = df.withColumnRenamed(first, "\ufeff" + first) if bom else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_versioned(df: DataFrame, root: str, name: str, start: str, end: str, params: dict, version: str = "v1") -> str:
    """Write a prior as a build ``build=<from>_<to>`` with its build parameters as columns, and make it the latest.

    Data goes to a folder of its own; ``builds/<from>_<to>.json`` and ``latest.json`` then name it. A
    reader sees whole builds only, also while one is repeated or fails; older folders stay.
    """
    meta = {"built_from": start, "built_to": end, **params, "version": version}
    out = df.withColumns({k: F.lit(v) for k, v in meta.items()})
    base, build = f"{root}/{name}", f"build={start}_{end}"
    folder = f"{manifest.fresh_folder(base)}/{build}"
    out.write.parquet(folder)
    content = {"folder": folder.removeprefix(f"{base}/"), **{k: str(v) for k, v in meta.items()}}
    for place in (f"builds/{start}_{end}.json", "latest.json"):
        manifest.commit(df.sparkSession, f"{base}/{place}", content)
    return folder


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    return _committed_build(spark, f"{root}/{name}", "latest.json")


def read_build(spark: SparkSession, root: str, name: str, start: str, end: str) -> DataFrame:
    return _committed_build(spark, f"{root}/{name}", f"builds/{start}_{end}.json")


def _committed_build(spark: SparkSession, base: str, place: str) -> DataFrame:
    found = manifest.committed(spark, f"{base}/{place}")
    if found is None:
        raise FileNotFoundError(f"no committed build {base}/{place}")
    return spark.read.parquet(f"{base}/{found['folder']}")


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """The same ``n`` rows on every run: the smallest seeded hashes."""
    return df.orderBy(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))), *keys).limit(n)
