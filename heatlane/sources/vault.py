"""Content-addressed file store: each content once, every path indexed."""

from __future__ import annotations

import gzip
import os
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatlane.operators.joins import sized_broadcast
from heatlane.operators.sets import upsert
from heatlane.session import durable
from heatlane.sources import manifest

DAY_IN_NAME = r"([0-9]{8})"


def scan_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(rel_path, mtime, size, content) of the files below a folder."""
    raw = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    )
    root = folder.rstrip("/") + "/"
    return raw.select(
        F.substring_index("path", root, -1).alias("rel_path"),
        F.col("modificationTime").cast("double").alias("mtime"),
        F.col("length").alias("size"),
        "content",
    )


def file_day(path, pattern: str = DAY_IN_NAME):
    """``YYYYMMDD`` in a file name, or null."""
    return F.nullif(F.regexp_extract(F.substring_index(path, "/", -1), pattern, 1), F.lit(""))


def files_by_date(listing: DataFrame, start: str | None, end: str | None, path: str = "rel_path",
                  pattern: str = DAY_IN_NAME, limit: int | None = None) -> DataFrame:
    """Files whose name carries a day in [start, end] (``YYYYMMDD``); files
    without a day are left out."""
    out = listing.withColumn("date_ymd", file_day(F.col(path), pattern)).where(F.col("date_ymd").isNotNull())
    if start is not None:
        out = out.where(F.col("date_ymd") >= start)
    if end is not None:
        out = out.where(F.col("date_ymd") <= end)
    return out.orderBy("date_ymd", path).limit(limit) if limit is not None else out


def day_grid(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per calendar day."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("date"))


def _gzip(content: Column) -> Column:
    """Packed row by row: a batch of whole files in Python would hold thousands of them at once."""
    return F.udf(lambda b: None if b is None else gzip.compress(b, mtime=0), "binary", useArrow=False).asNondeterministic()(content)


def vault_objects(files: DataFrame, compress: bool = False, index: DataFrame | None = None) -> DataFrame:
    """(sha256, size, is_gzip, bytes): each content once, out of its first path.

    Contents are hashed once, into a written table of paths (``index``, if there is one
    already); first paths are chosen there, and their bytes are read by path alone. Bytes don't move while the
    list of first paths is counted to be short. Paths are unique.
    """
    index = durable(vault_index(files), "hashed") if index is None else index
    first = F.min(F.struct("rel_path", "size"))
    winners = index.groupBy("sha256").agg(first.alias("f")).select("f.rel_path", "sha256", "f.size", F.lit(int(compress)).alias("is_gzip"))
    once = files.select("rel_path", F.col("content").alias("bytes")).join(sized_broadcast(winners), "rel_path")
    once = once.select("sha256", "size", "is_gzip", "bytes")
    return once.withColumn("bytes", _gzip(F.col("bytes"))) if compress else once


def vault_index(files: DataFrame, pattern: str = DAY_IN_NAME) -> DataFrame:
    """(rel_path, mtime, size, sha256, date_ymd): every path."""
    return files.select(
        "rel_path", "mtime", F.col("size").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"),
        file_day(F.col("rel_path"), pattern).alias("date_ymd"),
    )


def vault_ingest(files: DataFrame, compress: bool = False) -> tuple[DataFrame, DataFrame]:
    """(objects, index), both from one hashing of the files."""
    index = durable(vault_index(files), "hashed")
    return vault_objects(files, compress, index), index


def new_objects(objects: DataFrame, stored: DataFrame) -> DataFrame:
    """Contents the store does not hold yet."""
    return objects.join(stored.select("sha256"), "sha256", "left_anti")


def ingest_counts(index: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """One row: files seen, new contents, duplicates."""
    per_hash = index.groupBy("sha256").agg(F.count(F.lit(1)).alias("__n"))
    if stored is not None:
        per_hash = per_hash.join(stored.select("sha256").withColumn("__old", F.lit(1)), "sha256", "left")
    else:
        per_hash = per_hash.withColumn("__old", F.lit(None).cast("int"))
    fresh = F.sum(F.when(F.col("__old").isNull(), 1).otherwise(0))
    return per_hash.agg(
        F.sum("__n").cast("long").alias("n_files"),
        fresh.cast("long").alias("n_new"),
        (F.sum("__n") - fresh).cast("long").alias("n_duplicate"),
    )


def upsert_index(old: DataFrame, new: DataFrame) -> DataFrame:
    """Insert or replace by path: the newest modification time stays."""
    return upsert(old, new, ["rel_path"], ["mtime", "sha256"])


def store_index(new: DataFrame, root: str, buckets: int = 64) -> list[int]:
    """``upsert_index`` on a stored index: only the hash buckets that the new paths fall into are read and written."""
    return manifest.upsert_buckets(new, root, ["rel_path"], ["mtime", "sha256"], buckets)


def vault_select(index: DataFrame, objects: DataFrame, pattern: str, limit: int | None = None) -> DataFrame:
    """Indexed files whose path is LIKE the pattern, with their bytes."""
    picked = index.where(F.col("rel_path").like(pattern)).select("rel_path", "sha256", "size")
    if limit is not None:
        picked = picked.orderBy("rel_path").limit(limit)
    return picked.join(objects.select("sha256", "is_gzip", "bytes"), "sha256")


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a bare path is one of a shared disk."""
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri.removeprefix("file:")))


def vault_export(selected: DataFrame, folder: str) -> DataFrame:
    """Write the selected files below ``folder``, a URI all executors can reach; one
    row per file. A rerun writes the same bytes, so retries are harmless."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_store(folder)
        for pdf in batches:
            sizes = []
            for path, packed, data in zip(pdf["rel_path"], pdf["is_gzip"], pdf["bytes"]):
                raw = gzip.decompress(data) if packed else data
                target = f"{root}/{path}"
                store.create_dir(os.path.dirname(target))
                with store.open_output_stream(target) as f:
                    f.write(raw)
                sizes.append(len(raw))
            yield pd.DataFrame({"rel_path": pdf["rel_path"], "written": sizes})

    return selected.select("rel_path", "is_gzip", "bytes").mapInPandas(write, "rel_path string, written long")


def vault_summary(index: DataFrame) -> DataFrame:
    """Files and megabytes per top folder."""
    return index.groupBy(F.substring_index("rel_path", "/", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), (F.sum("size") / F.lit(1048576.0)).alias("mb")
    )


def vault_folders(index: DataFrame, folders: Sequence[str]) -> DataFrame:
    return index.where(F.substring_index("rel_path", "/", 1).isin(list(folders)))
