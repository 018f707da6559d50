"""History features on a stream, by (entity, axis).

State holds, per (entity, axis), the last ``n`` rows and the rows that wait. A row waits until the
watermark has passed its time; then it is emitted with the features of the ``n``
rows before it and becomes one of them. So an arriving start gets the numbers of
``windows.history_rates`` without another look at the history, whatever the
arrival order within the delay.

A call to the state store costs far more than a row, so state is keyed by a hash of (entity, axis): a group holds many
of them, packed as two Arrow tables, and all its rows are worked on at once. A batch reads and writes the groups it touches.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heatlane.streaming.posterior import FAR, rocksdb_state, run_to_table

#: Groups of (entity, axis) that share a state, and the group of rows that only move the watermark.
GROUPS, MARKERS = 1024, -1


def feature_names(flags: Sequence[str], valued: bool, n: int, suffix: str) -> list[str]:
    """Names as ``windows.history_rates`` gives them."""
    names = [f"{name}_{kind}_last{n}{suffix}" for name in flags for kind in ("cnt", "rate")]
    return names + [f"st_{kind}_last{n}{suffix}" for kind in ("mean", "std")] * valued


def features_of(rows: pd.DataFrame, keys: np.ndarray, flags: Sequence[str], valued: bool, n: int, suffix: str) -> pd.DataFrame:
    """Features of ``rows`` from the ``n`` rows of the same key before each; rows of a key lie together, in their order."""
    live = rows["live"].eq(True).to_numpy(dtype=bool)

    def before(values: np.ndarray, none) -> np.ndarray:
        """One line per row: what the n rows before it hold."""
        return sliding_window_view(np.concatenate([np.full(n, none), values])[:-1], n)

    same = before(keys, -1) == keys[:, None]

    def frames(column: str) -> np.ndarray:
        """One line per row: the values of the n rows of its key before it, NaN where there is none."""
        values = np.where(live, pd.to_numeric(rows[column]).to_numpy(dtype=float, na_value=np.nan), np.nan)
        return np.where(same, before(values, np.nan), np.nan)

    def counted(frame: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        here = ~np.isnan(frame)
        return here.sum(axis=1), np.where(here, frame, 0.0).sum(axis=1)

    out = {}
    with np.errstate(divide="ignore", invalid="ignore"):
        for name in flags:
            seen, total = counted(frames(name))
            out[f"{name}_cnt_last{n}{suffix}"] = seen
            out[f"{name}_rate_last{n}{suffix}"] = np.where(seen > 0, total / seen, np.nan)
        if valued:
            frame = frames("value")
            seen, total = counted(frame)
            mean = np.where(seen > 0, total / seen, np.nan)
            squares = np.nansum((frame - mean[:, None]) ** 2, axis=1)
            out[f"st_mean_last{n}{suffix}"] = mean
            out[f"st_std_last{n}{suffix}"] = np.where(seen > 1, np.sqrt(squares / (seen - 1)), np.nan)
    return pd.DataFrame(out, columns=feature_names(flags, valued, n, suffix))


def pack(rows: pd.DataFrame) -> tuple[bytes]:
    """The one field of a state that holds rows."""
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def unpack(state) -> list[pd.DataFrame]:
    """The rows of a state, none if it is empty."""
    return [pa.ipc.open_stream(bytes(state.get()[0])).read_all().to_pandas()] if state.exists() else []


class History(StatefulProcessor):
    def __init__(self, entity: str, axis: str, flags: Sequence[str], valued: bool, n: int, suffix: str):
        self.keys, self.flags, self.valued, self.n, self.suffix = [entity, axis], list(flags), valued, n, suffix
        self.names = [*self.keys, "ts_us", "id", "live", "value", *self.flags]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "rows binary")
        self.last = handle.getValueState("last", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = [pdf[self.names] for pdf in rows if key[0] != MARKERS and len(pdf)]
        if fresh:
            self.waiting.update(pack(pd.concat([*unpack(self.waiting), *fresh], ignore_index=True)))
            self.handle.registerTimer(min(int(pdf["ts_us"].min()) for pdf in fresh) // 1000 + 1)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # rows of a time before the watermark are all there
        now = 1000 * max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        held = unpack(self.waiting)
        due = [pdf[pdf["ts_us"] < now] for pdf in held]
        if not any(len(pdf) for pdf in due):
            yield pd.DataFrame()
            return
        rest = held[0][held[0]["ts_us"] >= now]
        both = pd.concat([pdf.assign(__now=late) for late, some in ((False, unpack(self.last)), (True, due)) for pdf in some], ignore_index=True)
        number = both.groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
        order = np.lexsort((both["id"], both["ts_us"], both["__now"], number))
        both, number = both.iloc[order].reset_index(drop=True), number[order]
        out = features_of(both, number, self.flags, self.valued, self.n, self.suffix)
        for place, column in enumerate(["id", *self.keys]):
            out.insert(place, column, both[column], allow_duplicates=True)
        out = out[both["__now"]].reset_index(drop=True)
        self.last.update(pack(both[self.names].groupby(number, sort=False).tail(self.n)))
        if len(rest):
            self.waiting.update(pack(rest))
            self.handle.registerTimer(int(rest["ts_us"].min()) // 1000 + 1)
        else:
            self.waiting.clear()
        yield out

    def close(self) -> None:
        pass


def history_stream(
    starts: DataFrame, entity: str, axis: str, ts: str, row_id: str, started: str, flags: Mapping[str, str], delay: str,
    value: str | None = None, n: int = 10, suffix: str = "", groups: int = GROUPS,
) -> DataFrame:
    """Streaming form of ``windows.history_rates``, ordered by (``ts``, ``row_id``): one row per start with ``row_id`` and the features.

    ``delay`` is how much later than others a start may arrive, such as "1 day";
    Spark leaves out later ones. Starts without entity or axis make no key and are left out here;
    their features are null in the batch form. State holds ``n`` rows a key and those within the delay, so a long
    history is read by the batch form and a stream takes over from there. ``groups`` can't change while a checkpoint is in use.
    """
    kinds = dict(starts.dtypes)
    ready = starts.withWatermark(ts, delay).select(
        entity, axis, ts, F.unix_micros(ts).alias("ts_us"), F.col(row_id).cast("long").alias("id"), F.col(started).alias("live"),
        (F.col(value) if value else F.lit(None)).cast("double").alias("value"),
        *[F.col(flag).cast("long").alias(name) for name, flag in flags.items()],
    ).where(F.col("id").isNull() | (F.col(entity).isNotNull() & F.col(axis).isNotNull()))
    shared = F.when(F.col("id").isNull(), MARKERS).otherwise(F.pmod(F.xxhash64(entity, axis), F.lit(groups))).cast("int")
    names = feature_names(list(flags), value is not None, n, suffix)
    schema = [f"id long, `{entity}` {kinds[entity]}, `{axis}` {kinds[axis]}"]
    schema += [f"`{name}` {'long' if '_cnt_last' in name else 'double'}" for name in names]
    out = ready.withColumn("__group", shared).groupBy("__group").transformWithStateInPandas(
        statefulProcessor=History(entity, axis, list(flags), value is not None, n, suffix),
        outputStructType=", ".join(schema), outputMode="Append", timeMode="EventTime",
    )
    return out.withColumnRenamed("id", row_id)


def run_history(starts: DataFrame, entity: str, axis: str, ts: str, row_id: str, *args, root: str, **kw) -> DataFrame:
    """Run a finite stream of starts to its end. The second run takes in one marker
    row far ahead, after which no start waits any more."""
    spark = starts.sparkSession
    marker = spark.range(1).select(F.to_timestamp(F.lit(FAR)).alias(ts), F.lit(None).cast("long").alias(row_id))
    marker.limit(0).write.mode("overwrite").parquet(f"{root}/marker")
    ends = spark.readStream.schema(marker.schema).parquet(f"{root}/marker")
    with rocksdb_state(spark):
        out = history_stream(starts.unionByName(ends, allowMissingColumns=True), entity, axis, ts, row_id, *args, **kw)
        run_to_table(out, f"{root}/rows", f"{root}/state")
        marker.write.mode("append").parquet(f"{root}/marker")
        run_to_table(out, f"{root}/rows", f"{root}/state")
    return spark.read.schema(out.schema).parquet(f"{root}/rows")
