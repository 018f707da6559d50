"""Tables whose versions are committed by one small file.

Data is written first, to a folder no reader knows. A manifest of a few names is then put in
place by one rename, which is the commit: readers see the old version or the new one, and a build that
fails or is repeated leaves what is committed as it was. One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatlane.operators.windows import keep_last


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system, the settings)."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = found.getFileSystem(settings)
    return found.makeQualified(store.getUri(), store.getWorkingDirectory()), store, settings


def commit(spark: SparkSession, path: str, content: dict) -> None:
    """Put ``content`` in place of the file ``path`` by a rename."""
    target, store, settings = _path(spark, path)
    fresh, _, _ = _path(spark, f"{path}.{uuid.uuid4().hex}")
    out = store.create(fresh, True)
    out.write(bytearray(json.dumps(content, sort_keys=True).encode()))
    out.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    replace = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    replace[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(store.getUri(), settings).rename(fresh, target, replace)


def committed(spark: SparkSession, path: str) -> dict | None:
    """Content of the manifest ``path``; None where nothing has been committed."""
    target, store, _ = _path(spark, path)
    if not store.exists(target):
        return None
    return json.loads(spark.read.text(str(target.toString()), wholetext=True).first()["value"])


def fresh_folder(root: str) -> str:
    return f"{root}/data/{uuid.uuid4().hex}"


BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a key; the same for equal keys of one type, null keys too."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, root: str) -> DataFrame | None:
    """The committed rows of a bucketed table; None before the first commit."""
    state = committed(spark, f"{root}/manifest.json")
    if state is None:
        return None
    paths = sorted(f"{root}/{folder}/{BUCKET}={b}" for b, folder in state["folders"].items())
    empty = spark.createDataFrame([], state["schema"])
    return spark.read.schema(empty.schema).parquet(*paths) if paths else empty


def upsert_buckets(new: DataFrame, root: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> list[int]:
    """Insert or replace by key, the last version in ``order`` stays; numbers of the buckets written.

    The table lies in hash buckets of its key. An upsert reads and writes only the buckets that ``new``
    has keys of (at most ``buckets`` numbers reach the driver); the others stay as files. The number of buckets and the columns
    are those of the first upsert. Several rows of a key in ``new`` are one; without rows nothing is written.
    """
    spark = new.sparkSession
    state = committed(spark, f"{root}/manifest.json")
    if state is None:
        state = {"buckets": buckets, "keys": list(keys), "schema": _ddl(new), "folders": {}}
    elif state["keys"] != list(keys) or state["schema"] != _ddl(new):
        raise ValueError(f"the table has keys {state['keys']} and columns {state['schema']}")
    numbered = new.withColumn(BUCKET, bucket_of(keys, state["buckets"]))
    touched = sorted(r[BUCKET] for r in numbered.select(BUCKET).distinct().collect())
    if not touched:
        return []
    old = [f"{root}/{state['folders'][str(b)]}/{BUCKET}={b}" for b in touched if str(b) in state["folders"]]
    if old:
        rows = spark.read.schema(new.schema).parquet(*old)
        numbered = rows.withColumn(BUCKET, bucket_of(keys, state["buckets"])).unionByName(numbered)
    folder = fresh_folder(root)
    last = keep_last(numbered, [BUCKET, *keys], order)
    last.repartition(len(touched), BUCKET).write.partitionBy(BUCKET).parquet(folder)
    state["folders"].update({str(b): folder.removeprefix(f"{root}/") for b in touched})
    commit(spark, f"{root}/manifest.json", state)
    return touched


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
