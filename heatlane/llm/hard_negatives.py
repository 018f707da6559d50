"""Hard-negative mining with Four-Russians scoring.

Candidates are kept as bit planes: for each group of eight dimensions and each bit of the components one byte.
An anchor has a table of its 256 subset sums per group; a byte names the sum of those components whose bit is set.
Adding the lookups of a group, shifted by one bit from plane to plane, gives the full inner product, exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatlane.llm.common import column, past_shards
from heatlane.session import durable

SCALE, EVERY, POSITIVES, NEGATIVES = 256.0, 100, 5, 10
#: A negative's score lies between these shares, in hundredths, of the positive's.
LOW, HIGH = 30, 90
GROUP = 8
SHARD_ROWS, BLOCK_ANCHORS = 8192, 512
#: Anchors whose tables are read at once.
_AT_ONCE = 32


def labelled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``label`` and ``v`` (doubles), each id once.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no part. Of rows with
    one id the least in label, then vector, stays. Other columns are not read.
    """
    fine = F.forall(column(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform(column(vector_col), lambda x: x.cast("double"))
    made = vectors.select(column(id_col).cast("long").alias("vec_id"), F.struct(column(label_col).cast("long").alias("label"), F.when(fine, v).alias("v")).alias("row"))
    made = made.filter("vec_id is not null and row.label is not null and row.v is not null")
    return made.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")


def whole_numbers(values: np.ndarray, scale: float = SCALE) -> np.ndarray:
    """floor(scale * x) per component; Python integers where a long could not hold them."""
    with np.errstate(over="ignore"):
        made = np.floor(scale * values)
    if np.abs(made).max(initial=0) < 2.0**62:
        return made.astype(np.int64)
    wide = [int(x) * int(scale) if not np.isfinite(y) else int(y) for x, y in zip(values.flat, made.flat, strict=True)]
    return np.array(wide, dtype=object).reshape(values.shape)


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """Two's complement of the components, packed: (planes, groups, rows) bytes, lowest plane first; the last is the sign."""
    least, most = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
    bits = max((least if least >= 0 else ~least).bit_length(), most.bit_length()) + 1
    planes = []
    for b in range(bits):
        bit = ((rows >> b) & 1).astype(np.uint8)
        planes.append(np.packbits(bit, axis=1, bitorder="little").T)
    return np.ascontiguousarray(planes).reshape(bits, -1, len(rows))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, anchors, 256): the sums of all subsets of each anchor's eight components of a group."""
    n, width = anchors.shape
    groups = -(-width // GROUP)
    padded = np.zeros((n, groups * GROUP), dtype=anchors.dtype)
    padded[:, :width] = anchors
    parts = padded.reshape(n, groups, GROUP).transpose(1, 0, 2)
    sums = np.zeros((groups, n, 1 << GROUP), dtype=anchors.dtype)
    for j in range(GROUP):
        sums[:, :, 1 << j : 2 << j] = sums[:, :, : 1 << j] + parts[:, :, j : j + 1]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(anchors, rows): inner products from lookups, shifted by one bit per plane; the shorter vector ends in zeros."""
    total = np.zeros((sums.shape[1], planes.shape[2]), dtype=sums.dtype)
    for g in range(min(len(sums), planes.shape[1])):
        part = -np.take(sums[g], planes[-1, g], axis=1)
        for plane in planes[-2::-1]:
            part = part + part + np.take(sums[g], plane[g], axis=1)
        total += part
    return total


def _packed(rows: DataFrame, size: int, planes: bool) -> DataFrame:
    """Rows in numbered shards of about ``size``: ids and labels, and bit planes or plain components."""
    n = max(1, -(-rows.count() // size))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        vectors = table.column("v").combine_chunks()
        lengths = np.diff(vectors.offsets.to_numpy())
        matrix = np.zeros((table.num_rows, int(lengths.max(initial=1))))
        matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
        made = bit_planes(whole_numbers(matrix)) if planes else matrix
        out = {"shard": [table.column("shard")[0].as_py()], "bits": [made.shape[0]], "parts": [made.shape[1]], "data": [made.tobytes()]}
        out |= {c: [table.column(s).to_numpy().astype("<i8").tobytes()] for c, s in (("ids", "vec_id"), ("labels", "label"))}
        kinds = [("shard", pa.int64()), ("bits", pa.int64()), ("parts", pa.int64()), ("data", pa.binary()), ("ids", pa.binary()), ("labels", pa.binary())]
        return pa.table({c: pa.array(out[c], k) for c, k in kinds})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(n)))
    return durable(dealt.groupBy("shard").applyInArrow(pack, "shard long, bits long, parts long, data binary, ids binary, labels binary"), "packed")


def _held(shard: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(shard[c], dtype="<i8") for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(shard["data"], dtype=np.uint8).reshape(shard["bits"], shard["parts"], len(ids))


def _scored(held, row: dict):
    """(places of some anchors of a block, their scores with all rows of the shard)."""
    planes = held[2]
    matrix = whole_numbers(np.frombuffer(row["data"]).reshape(row["bits"], row["parts"]))
    most = int(np.abs(matrix).max(initial=0)) * matrix.shape[1] << planes.shape[0]
    if most >= 1 << 62:
        matrix = matrix.astype(object)  # exact beyond a long
    for at in range(0, len(matrix), _AT_ONCE):
        some = np.arange(at, min(at + _AT_ONCE, len(matrix)))
        yield some, scores(subset_sums(matrix[some]), planes)


def _fits(values: list) -> pa.Array:
    if any(not -(1 << 63) <= int(x) < 1 << 63 for x in values):
        raise ValueError("a score does not fit a long")
    return pa.array([int(x) for x in values], pa.int64())


def _first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id; ids ascend."""
    if len(score) > 4 * k and score.dtype != object:
        score_k = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= score_k)
        return near[np.argsort(-score[near], kind="stable")[:k]]
    return np.array(sorted(range(len(score)), key=lambda i: -score[i])[:k], dtype=np.int64)


def positives(shards: DataFrame, anchors: DataFrame, k: int = POSITIVES) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``positive_score``: each anchor's first ``k`` other rows of its label."""

    def run(held, row):
        ids, labels, _ = held
        own, own_label = (np.frombuffer(row[c], dtype="<i8") for c in ("ids", "labels"))
        out = ([], [], [])
        for some, found in _scored(held, row):
            for a, score in zip(some, found, strict=True):
                same = np.flatnonzero((labels == own_label[a]) & (ids != own[a]))
                best = same[_first(score[same], ids[same], k)]
                out[0].extend([own[a]] * len(best))
                out[1].extend(ids[best])
                out[2].extend(score[best])
        yield pa.RecordBatch.from_arrays([_fits(x) for x in out], ["anchor_id", "positive_id", "positive_score"])

    found = past_shards(shards, anchors, run, "anchor_id long, positive_id long, positive_score long", _held)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).drop("n")


def negatives(shards: DataFrame, anchors: DataFrame, chosen: DataFrame, k: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """For each row of ``chosen`` (anchor_id, positive_id, positive_score) the first ``k`` rows of another label with
    low * positive_score <= 100 * score <= high * positive_score; ``chosen`` travels with its anchors' blocks."""
    per_block = anchors.select("shard", F.explode("anchor_ids").alias("anchor_id")).join(chosen, "anchor_id")
    pairs = per_block.groupBy("shard").agg(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score")).alias("chosen"))
    passing = anchors.drop("anchor_ids").join(pairs, "shard")
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]

    def run(held, row):
        ids, labels, _ = held
        own, own_label = (np.frombuffer(row[c], dtype="<i8") for c in ("ids", "labels"))
        of_anchor: dict[int, list] = {}
        for c in row["chosen"]:
            of_anchor.setdefault(c["anchor_id"], []).append((c["positive_id"], c["positive_score"]))
        out = ([], [], [], [], [])
        for some, found in _scored(held, row):
            for a, score in zip(some, found, strict=True):
                for positive, mark in of_anchor.get(int(own[a]), ()):
                    # 100 * score within low * mark .. high * mark, in whole numbers and without overflow
                    inside = (score >= -(-low * mark // 100)) & (score <= high * mark // 100) & (labels != own_label[a])
                    there = np.flatnonzero(inside)
                    best = there[_first(score[there], ids[there], k)]
                    for x, y in zip(out, ([own[a]] * len(best), [positive] * len(best), ids[best], [mark] * len(best), score[best]), strict=True):
                        x.extend(y)
        yield pa.RecordBatch.from_arrays([_fits(x) for x in out], names)

    found = past_shards(shards, passing, run, ", ".join(f"{n} long" for n in names), _held)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mine(rows: DataFrame, anchors: DataFrame, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, shard_rows: int = SHARD_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Both inputs as ``labelled`` gives them. Every anchor is scored with every row, once for its positives and once
    for their negatives. Equal scores go by ascending id. Vectors of different lengths meet as if the shorter ended in zeros.
    Anchors without another row of their label, and positives without a row in their range, have no result; nor do empty
    tables. Components of any finite size are exact; a score that a long cannot hold raises an error.
    """
    shards = _packed(rows, shard_rows, planes=True)
    blocks = _packed(anchors, block_anchors, planes=False)
    chosen = durable(positives(shards, blocks, n_positives), "positives")
    numbered = durable(_with_ids(blocks), "anchors")
    return negatives(shards, numbered, chosen, n_negatives)


def _with_ids(blocks: DataFrame) -> DataFrame:
    """Blocks with ``anchor_ids``, their ids as an array."""

    def run(batches):
        for batch in batches:
            made = [np.frombuffer(x.as_buffer(), dtype="<i8") for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.int64()))], [*batch.schema.names, "anchor_ids"])

    kinds = ", ".join(f"{n} {t}" for n, t in blocks.dtypes)
    return blocks.mapInArrow(run, f"{kinds}, anchor_ids array<long>")
