"""Token counts of documents in flat token files, by a scan for separators.

A token file is nothing but ids of fixed width; an end id follows each document.
There is no index, so blocks are cut anywhere and boundaries are stitched after.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.fs as fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heatlane.llm import tokens
from heatlane.llm.common import column, text_of
from heatlane.session import durable, scratch_path

END_ID, WIDTH = tokens.SPECIAL_ID, 2
#: Bytes that are searched at once.
BLOCK_BYTES = 1 << 22
#: Blocks of a file that are stitched in one task.
GROUP_BLOCKS = 1024


def _open(uri: str):
    """File system and path. Spark may write a local path with one slash."""
    if "://" not in uri:
        uri = "file://" + re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def write_token_files(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, width: int = WIDTH,
    vocabulary: str | None = None,
) -> DataFrame:
    """Writes one file per task below ``folder`` and returns (file, ordinal, doc_id) for
    each document written. Texts are ordinary text, so the end id occurs only
    as a separator. A repeated task writes a file of another name; files of lost
    attempts are in no row of the result. Null text: no ids but the end id."""
    path = vocabulary or tokens.vocabulary()
    kind = docs.select(column(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode, name, out, at = tokens.encoder(path, False), f"part-{uuid.uuid4().hex}.bin", None, 0
        for batch in batches:
            if out is None:
                store, place = _open(folder)
                store.create_dir(place)
                out = store.open_output_stream(f"{place}/{name}")
            for text in batch.column(1):
                out.write(np.append(encode(text.as_py()), np.uint32(end_id)).astype(f"<u{width}").tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.string()), pa.array(np.arange(at, at + n), pa.int64()), batch.column(0)], ["file", "ordinal", "doc_id"]
            )
            at += n
        if out is not None:
            out.close()

    given = docs.select(column(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return durable(given.mapInArrow(run, f"file string, ordinal long, doc_id {kind}"), "written")


def scan_token_files(
    spark: SparkSession, folder: str, files: DataFrame | None = None, end_id: int = END_ID, width: int = WIDTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(file, ordinal, n_tokens, complete) of each document in the flat files of a
    folder, or of those that ``files`` names; ``file`` is the name within the folder.

    Each block is searched in one vectorised comparison. What a block can't know,
    how many documents ended before it and where the last one did, is a
    running sum and a running maximum over the blocks of its file, two numbers per block: over groups of
    ``GROUP_BLOCKS`` blocks first, then inside each group, so one file is stitched in many tasks. Ids after the
    last separator are a document that isn't complete. Files without a byte, and
    bytes at an end that make no whole id, give nothing.
    """
    block_bytes -= block_bytes % width
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    listed = listed.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.expr(f"length - length % {width}").alias("size"))
    if files is not None:
        listed = listed.join(files.select("file").distinct(), "file", "left_semi")
    blocks = listed.filter(F.col("size") > 0).select(
        "file", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block_bytes).cast("long"))).alias("block", "at"), "size"
    ).select("file", "block", "at", F.least(F.lit(block_bytes).cast("long"), F.col("size") - F.col("at")).alias("bytes"))

    def run(batches):
        for batch in batches:
            out = defaultdict(list)
            for row in batch.to_pylist():
                store, place = _open(folder)
                with store.open_input_file(f"{place}/{row['file']}") as f:
                    ids = np.frombuffer(f.read_at(row["bytes"], row["at"]), dtype=f"<u{width}")
                out["file"].append(row["file"])
                out["block"].append(row["block"])
                out["start"].append(row["at"] // width)
                out["n"].append(len(ids))
                out["ends"].append((np.flatnonzero(ids == end_id) + row["at"] // width).tolist())
                out["n_ends"].append(len(out["ends"][-1]))
                out["last"].append(out["ends"][-1][-1] if out["ends"][-1] else None)
            types = {"file": pa.string(), "block": pa.int32(), "start": pa.int64(), "n": pa.int64(), "ends": pa.list_(pa.int64())}
            types |= {"n_ends": pa.int64(), "last": pa.int64()}
            yield pa.RecordBatch.from_pydict({c: pa.array(out[c], t) for c, t in types.items()})

    schema = "file string, block int, start long, n long, ends array<long>, n_ends long, last long"
    found = durable(blocks.repartition("file", "block").mapInArrow(run, schema), "ends")
    carried = durable(_carried(found.select("file", "block", "n_ends", "last")), "carried")
    stitched = found.select("file", "block", "ends").join(carried, ["file", "block"])
    ended = stitched.select("file", "done", "open", "ends", F.posexplode("ends").alias("i", "end")).select(
        "file", (F.col("done") + F.col("i")).alias("ordinal"),
        (F.col("end") - F.when(F.col("i") == 0, F.col("open")).otherwise(F.get("ends", F.col("i") - 1) + 1)).alias("n_tokens"),
        F.lit(True).alias("complete"),
    )
    tails = found.groupBy("file").agg(
        F.sum("n_ends").alias("ordinal"),
        (F.max(F.col("start") + F.col("n")) - F.coalesce(F.max("last") + 1, F.lit(0))).alias("n_tokens"),
    )
    return ended.unionByName(tails.filter(F.col("n_tokens") > 0).withColumn("complete", F.lit(False)))


def _carried(blocks: DataFrame) -> DataFrame:
    """``done``, the documents that ended in earlier blocks of the file, and ``open``, the place after the last such end."""
    grouped = blocks.withColumn("group", F.floor(F.col("block") / GROUP_BLOCKS))
    upto = (Window.unboundedPreceding, -1)
    over = Window.partitionBy("file").orderBy("group").rowsBetween(*upto)
    totals = grouped.groupBy("file", "group").agg(F.sum("n_ends").alias("g_ends"), F.max("last").alias("g_last"))
    totals = totals.select("file", "group", F.sum("g_ends").over(over).alias("g_done"), F.max("g_last").over(over).alias("g_open"))
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(*upto)
    done = grouped.select("file", "group", "block", F.sum("n_ends").over(inside).alias("done"), F.max("last").over(inside).alias("open"))
    zero = F.lit(0).cast("long")
    return done.join(durable(totals, "groups"), ["file", "group"]).select(
        "file", "block", (F.coalesce("g_done", zero) + F.coalesce("done", zero)).alias("done"),
        F.coalesce(F.col("open") + 1, F.col("g_open") + 1, zero).alias("open"),
    )


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``n_tokens`` (without the separator), one row per input row:
    writes the documents as token files to the shared folder and scans these.
    Null and empty texts have no token; texts of any length are whole. Rows of one id, null ids and repeated rows each have
    a count of their own. An empty table gives an empty result. Other columns are not read."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    written = write_token_files(docs, folder, id_col, text_col)
    if written.isEmpty():
        return written.select("doc_id", F.col("ordinal").alias("n_tokens"))
    counted = scan_token_files(spark, folder, written)
    return written.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")
