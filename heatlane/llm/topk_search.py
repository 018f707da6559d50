"""Exact top-k search: the threshold algorithm over sorted per-dimension lists.

Vectors are dealt to shards. A shard keeps, for each dimension, its rows in order
of that component. Queries read the lists from both ends in growing steps, score
every row they meet, and stop when no unseen row can reach the kth score.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatlane.llm.common import column, past_shards
from heatlane.session import durable

K, SCALE, EVERY = 20, 64, 20
#: Rows of a shard and queries of a block; one task holds one of each.
SHARD_ROWS, BLOCK_QUERIES = 4096, 1024
#: Depth of the first step into the lists; each step is twice as deep.
FIRST_DEPTH = 16
LEAST, MOST = -(2**63), 2**63 - 1


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``vec_id`` and ``v``, an array of floor(scale * x), x as double; kept as doubles, which hold these whole numbers exactly.

    Rows with a null id, a null vector, or a component that is null or not finite
    take no part; finite ones of any size do. Of rows with one id, the least vector stays.
    """
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    whole = F.transform(  # doubles from 2^52 on are whole, and may be too large for a long
        column(vector_col), lambda x: F.when(F.abs(scaled(x)) < float(2**52), F.floor(scaled(x)).cast("double")).otherwise(scaled(x))
    )
    fine = F.forall(column(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    made = vectors.select(column(id_col).cast("long").alias("vec_id"), F.when(fine, whole).alias("v"))
    return made.filter("vec_id is not null and v is not null").groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(blob: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.float64).reshape(rows, -1)


def _shards(rows: DataFrame, size: int, lists: bool) -> DataFrame:
    """Rows packed into shards of about ``size``: ids, components, and with
    ``lists`` the order of the rows in each dimension."""
    n = max(1, -(-rows.count() // size))
    schema = "shard long, n long, ids binary, components binary, orders binary"

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        vectors = table.column("v").combine_chunks()
        width = int(max(1, max(np.diff(vectors.offsets.to_numpy()), default=1)))
        matrix = np.zeros((len(ids), width))  # shorter vectors end in zeros
        for i, v in enumerate(vectors.to_pylist()):
            matrix[i, : len(v)] = v
        ids, matrix = ids[order], matrix[order]
        orders = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int32) if lists else np.zeros(0, np.int32)
        row = {"shard": [table.column("shard")[0].as_py()], "n": [len(ids)], "ids": [ids.tobytes()], "components": [matrix.tobytes()]}
        return pa.Table.from_pydict(
            row | {"orders": [np.ascontiguousarray(orders).tobytes()]},
            pa.schema([("shard", pa.int64()), ("n", pa.int64()), *[(c, pa.binary()) for c in ("ids", "components", "orders")]]),
        )

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(n)))
    return durable(dealt.groupBy("shard").applyInArrow(pack, schema), "shards")


def _product(queries: np.ndarray, rows: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; in doubles where these hold them exactly."""
    if exact:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def threshold_search(
    ids: np.ndarray, rows: np.ndarray, orders: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, first: int = FIRST_DEPTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of the k best rows of a shard for each query.

    ``ids`` ascend. A query's row of its own id is no candidate. The bound on all
    unseen rows sums, over the dimensions, the query's component times the value its
    list has reached, from the upper end where the component is positive and from
    the lower end where it is negative. A query is done when its kth score is above
    the bound, as an equal score could still win by its id.
    """
    width = max(rows.shape[1], queries.shape[1])
    rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    orders = np.vstack([orders, np.tile(np.arange(len(ids), dtype=orders.dtype), (width - len(orders), 1))])
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * width
    exact = most < 2**53
    n, m = len(ids), len(queries)
    none = np.iinfo(np.int64).min + 1  # its negative is a long too
    best, best_ids = np.full((m, k), none), np.full((m, k), np.iinfo(np.int64).max)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    active, seen, depth = np.arange(m), np.zeros(n, dtype=bool), 0
    while len(active) and depth < n:
        deeper = min(n, max(first, 2 * depth))
        met = np.zeros(n, dtype=bool)
        met[orders[:, depth:deeper]] = True
        met[orders[:, n - deeper : n - depth]] = True
        new = np.flatnonzero(met & ~seen)
        seen |= met
        depth = deeper
        if len(new):
            scores = _product(queries[active], rows[new], exact)
            scores = np.where(ids[new][None, :] == query_ids[active][:, None], none, scores)
            if len(new) > 4 * k:  # all that reach the kth of the new ones; ties are settled below
                cut = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
                keep = (scores >= np.maximum(cut, best[active][:, -1:])).any(axis=0)
                new, scores = new[keep], scores[:, keep]
            pool = np.concatenate([best[active], scores], axis=1)
            pool_ids = np.concatenate([best_ids[active], np.broadcast_to(ids[new], (len(active), len(new)))], axis=1)
            order = np.lexsort((pool_ids, -pool), axis=1)[:, :k]
            best[active] = np.take_along_axis(pool, order, axis=1)
            best_ids[active] = np.take_along_axis(pool_ids, order, axis=1)
        if seen.all():
            break
        dims = np.arange(width)
        high, low = rows[orders[:, n - depth], dims], rows[orders[:, depth - 1], dims]
        bound = _product(up[active], high[None, :], exact)[:, 0] + _product(down[active], low[None, :], exact)[:, 0]
        active = active[best[active][:, -1] <= bound]
    q, place = np.nonzero(best > none)
    return query_ids[q], best_ids[q, place], best[q, place]


def _whole(matrix: np.ndarray) -> np.ndarray:
    """Python integers, for components whose products may pass a long."""
    return np.array([[int(x) for x in row] for row in matrix.tolist()], dtype=object).reshape(matrix.shape)


def wide_search(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> list[tuple[int, int, int]]:
    """(query, vec_id, score) of the k best rows, each scored in Python integers of any size."""
    found = []
    if len(rows) and len(queries):
        width = max(rows.shape[1], queries.shape[1])
        held = _whole(np.pad(rows, ((0, 0), (0, width - rows.shape[1]))))
        for q, values in zip(query_ids.tolist(), _whole(np.pad(queries, ((0, 0), (0, width - queries.shape[1])))), strict=True):
            scores = (held * values).sum(axis=1) if width else [0] * len(held)
            scored = ((-s, i) for s, i in zip(scores, ids.tolist(), strict=True) if i != q)
            found += [(q, i, -s) for s, i in heapq.nsmallest(k, scored)]
    return found


def search_shard(shard: dict, block: dict, k: int) -> pa.RecordBatch:
    """The k best rows of a shard for the queries of a block.

    Rows and queries whose products stay within a long go through ``threshold_search``. Pairs with a larger row or query are few or
    many, and all are scored exactly. A score that fits no long is given as the nearest long with ``beyond`` set.
    """
    ids, rows = np.frombuffer(shard["ids"], dtype=np.int64), _matrix(shard["components"], shard["n"])
    query_ids, queries = np.frombuffer(block["ids"], dtype=np.int64), _matrix(block["components"], block["n"])
    limit = np.sqrt(2.0**62 / max(rows.shape[1], queries.shape[1], 1))
    plain, asked = [np.abs(m).max(axis=1, initial=0) < limit for m in (rows, queries)]
    if plain.all():
        orders = np.frombuffer(shard["orders"], dtype=np.int32).reshape(rows.shape[1], -1)
    else:
        orders = np.argsort(rows[plain], axis=0, kind="stable").T.astype(np.int32)
    out = threshold_search(ids[plain], rows[plain].astype(np.int64), orders, query_ids[asked], queries[asked].astype(np.int64), k)
    more = wide_search(ids[~plain], rows[~plain], query_ids[asked], queries[asked], k)
    more += wide_search(ids, rows, query_ids[~asked], queries[~asked], k)
    near = [max(LEAST, min(MOST, s)) for _, _, s in more]
    columns = [np.concatenate([out[c], np.array([m[c] for m in more], dtype=np.int64)]) for c in (0, 1)]
    scores = np.concatenate([out[2], np.array(near, dtype=np.int64)])
    beyond = np.concatenate([np.zeros(len(out[0]), dtype=bool), np.array([n != m[2] for n, m in zip(near, more, strict=True)], dtype=bool)])
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (*columns, scores, beyond)], names=["query_id", "vec_id", "score", "beyond"])


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each query the ``k``
    rows of highest integer inner product (all, if fewer), ties to the smaller id.

    Both inputs have ``vec_id`` and ``v`` as ``quantised`` gives them, each id once; empty ones give no rows.
    Vectors of different lengths meet as if the shorter ended in zeros. One copy of a shard
    moves and the blocks of queries stream past it; from each go at most k rows per
    query, and Spark keeps k per query again before it shuffles them. Components of any size are scored exactly;
    a result whose score fits no long stops the job.
    """
    shards, blocks = _shards(rows, shard_rows, lists=True), _shards(queries, block_queries, lists=False)

    def run(shard: dict, block: dict):
        yield search_shard(shard, block, k)

    found = past_shards(shards, blocks.select("n", "ids", "components"), run, "query_id long, vec_id long, score long, beyond boolean")
    return ranked(found, k)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    score = F.when(F.col("beyond"), F.raise_error(F.lit("a score does not fit a long")).cast("long")).otherwise(F.col("score"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", score.alias("score"))


def is_query(every: int = EVERY) -> Column:
    return F.col("vec_id") % every == 0
