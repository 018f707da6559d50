"""Best-fit packing: sequences of bounded length, improved by swaps between underfull bins."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatlane.llm import tokens
from heatlane.llm.common import column, text_of
from heatlane.session import durable

CAPACITY, END_ID = 1024, 2
#: Items that one task packs together; the number of tasks follows the input.
BLOCK_ITEMS = 16384
#: A trade that leaves a bin with more free ids than this isn't looked for.
MAX_SLACK = 32
#: Further rounds over the bins that are still underfull, dealt anew each time.
ROUNDS = 2


def cut(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    vocabulary: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    and ``ids`` on request. A document's ids end with ``end_id``; one longer than
    ``capacity`` is cut into full pieces, of which only the first may be shorter.
    A null text is empty and gives the end id alone."""
    path = vocabulary or tokens.vocabulary()
    kind = docs.select(column(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def run(batches):
        encode = tokens.encoder(path, True)
        for batch in batches:
            rows, out = [], defaultdict(list)
            for i, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py()), np.uint32(end_id)).astype("<u4")
                starts = [0] if len(ids) <= capacity else sorted({0, *range(len(ids) % capacity, len(ids), capacity)})
                for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append(i)
                    out["piece"].append(piece)
                    out["start"].append(a)
                    out["length"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        out["ids"].append(ids[a:b].astype("i4"))
            made = {"doc_id": batch.column(0).take(pa.array(rows, pa.int64())), "piece": pa.array(out["piece"], pa.int32())}
            made |= {c: pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")}
            if with_ids:
                made["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(made)

    return docs.select(column(id_col).alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


class Bins:
    """Bins of one block. ``room`` finds a bin by free space, ``where`` by free
    space and the length of an item in it; both know underfull bins only."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []  # (length, item) by bin
        self.free: list[int] = []
        self.room: dict[int, set[int]] = defaultdict(set)
        self.mask = 0  # bit f: some bin has f free
        self.where: dict[tuple[int, int], set[int]] = defaultdict(set)
        self.count = np.zeros(capacity + 1, dtype=np.int32)
        self.has = np.zeros((capacity + 1, capacity + 1), dtype=np.int32)

    def add(self, items: list[tuple[int, int]]) -> int:
        self.items.append(items)
        self.free.append(self.capacity - sum(n for n, _ in items))
        self.show(len(self.items) - 1)
        return len(self.items) - 1

    def show(self, b: int) -> None:
        f = self.free[b]
        if f:
            self.room[f].add(b)
            self.mask |= 1 << f
            self.count[f] += 1
            for n in {n for n, _ in self.items[b]}:
                self.where[f, n].add(b)
                self.has[f, n] += 1

    def hide(self, b: int) -> None:
        f = self.free[b]
        if f:
            self.room[f].discard(b)
            self.count[f] -= 1
            if not self.room[f]:
                self.mask &= ~(1 << f)
            for n in {n for n, _ in self.items[b]}:
                self.where[f, n].discard(b)
                self.has[f, n] -= 1

    def change(self, b: int, out: list[tuple[int, int]], put: list[tuple[int, int]]) -> None:
        self.hide(b)
        for x in out:
            self.items[b].remove(x)
        self.items[b] += put
        self.free[b] = self.capacity - sum(n for n, _ in self.items[b])
        self.show(b)

    def best_fit(self, n: int) -> int | None:
        """The bin with the least free space that takes ``n``."""
        fits = self.mask >> n
        if not fits:
            return None
        return next(iter(self.room[n + (fits & -fits).bit_length() - 1]))

    def trade(self, n: int) -> tuple[int, int] | None:
        """A bin, and the length of an item there, that takes ``n`` for that item
        and is left with the least free space."""
        free = np.flatnonzero(self.count[: min(self.capacity, n)])
        for slack in range(min(int(free.max()), MAX_SLACK) if len(free) else 0):
            f = free[free > slack]
            hit = f[self.has[f, n - f + slack] > 0]
            if len(hit):
                f = int(hit[-1])
                return next(iter(self.where[f, n - f + slack])), n - f + slack
        return None


def improve(bins: Bins) -> None:
    """Empties bins from the least filled on. An item moves to the fullest bin
    with room for it, or is exchanged for a shorter one (or two items for one)
    of a fuller bin; each step takes from a bin and gives to one at least as
    full, so the sum of squared fills rises until nothing is left to gain."""
    least = -(-sum(bins.capacity - f for f in bins.free) // bins.capacity)
    used = sum(1 for x in bins.items if x)
    for b in sorted((b for b, f in enumerate(bins.free) if f), key=lambda b: -bins.free[b]):
        if used <= least:
            return
        if not bins.free[b] or not bins.items[b]:
            continue
        bins.hide(b)
        mine = sorted(bins.items[b], reverse=True)
        bins.items[b], bins.free[b] = [], 0  # out of sight while its items are given away
        moved = True
        while mine and moved:
            moved = False
            for x in sorted(mine, reverse=True):
                if (to := bins.best_fit(x[0])) is not None:
                    bins.change(to, [], [x])
                    mine.remove(x)
                    moved = True
                    break
                if (found := bins.trade(x[0])) is not None:
                    to, n = found
                    back = next(y for y in bins.items[to] if y[0] == n)
                    bins.change(to, [back], [x])
                    mine.remove(x)
                    mine.append(back)
                    moved = True
                    break
            if not moved and len(mine) > 1:
                pairs = [(x, y) for i, x in enumerate(mine[:8]) for y in mine[i + 1 : 9] if x[0] + y[0] <= bins.capacity]
                for x, y in pairs:
                    if (found := bins.trade(x[0] + y[0])) is not None:
                        to, n = found
                        back = next(z for z in bins.items[to] if z[0] == n)
                        bins.change(to, [back], [x, y])
                        mine.remove(x)
                        mine.remove(y)
                        mine.append(back)
                        moved = True
                        break
        bins.items[b], bins.free[b] = mine, bins.capacity - sum(n for n, _ in mine)
        if mine:
            bins.show(b)
        else:
            bins.free[b] = 0
            used -= 1


def pack_block(lengths: np.ndarray, bin_of: np.ndarray | None, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, offset and fill for each item. Without given bins, items start by best
    fit in order of falling length."""
    bins = Bins(capacity)
    if bin_of is None:
        for i in np.argsort(-lengths, kind="stable").tolist():
            n = int(lengths[i])
            to = bins.best_fit(n)
            if to is None:
                bins.add([(n, i)])
            else:
                bins.change(to, [], [(n, i)])
    else:
        groups = defaultdict(list)
        for i, b in enumerate(bin_of.tolist()):
            groups[b].append((int(lengths[i]), i))
        for items in groups.values():
            bins.add(items)
    improve(bins)
    out = np.zeros((3, len(lengths)), dtype=np.int64)
    for b, items in enumerate(bins.items):
        at, fill = 0, sum(n for n, _ in items)
        for n, i in sorted(items, key=lambda x: x[1]):
            out[:, i] = b, at, fill
            at += n
    return out[0], out[1], out[2]


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_items: int = BLOCK_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` between 1 and ``capacity``.

    Full pieces are sequences of their own. The others are dealt at random to
    blocks of about ``block_items``, each packed in one task by best fit and then
    by swaps. Bins still underfull are dealt anew, as whole bins, and swapped
    again in each further round, so what blocks could not fill meets.
    ``sequence_id`` is the number of the sequence's first row. Rows are numbered
    in a written table, so a repeated task sees the same numbers; repeated
    rows are items of their own. An empty table gives an empty result.
    """
    names = [c for c in pieces.columns if c not in ("row", "sequence_id", "offset", "fill", "block")]
    numbered = durable(pieces.select(*names).withColumn("row", F.monotonically_increasing_id()), "pieces")
    own = numbered.filter(F.col("length") == capacity).select(*names, F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = numbered.filter(F.col("length") < capacity)
    schema = rest.withColumns({c: F.lit(0).cast("long") for c in ("sequence_id", "offset", "fill")}).schema

    def packer(keep_bins: bool):
        def run(table: pa.Table) -> pa.Table:
            row = table.column("row").to_numpy()
            order = np.argsort(row)
            table, row = table.take(pa.array(order)), row[order]
            given = table.column("sequence_id").to_numpy() if keep_bins else None
            b, offset, fill = pack_block(table.column("length").to_numpy(), given, capacity)
            first = np.full(int(b.max()) + 1, np.iinfo(np.int64).max)
            np.minimum.at(first, b, row)
            base = table.select([*names, "row"])
            for name, values in (("sequence_id", first[b]), ("offset", offset), ("fill", fill)):
                base = base.append_column(name, pa.array(values, pa.int64()))
            return base

        return run

    done = [own]
    for k in range(rounds + 1):
        blocks = max(1, -(-rest.count() // block_items))
        key = F.col("sequence_id" if k else "row")
        dealt = rest.withColumn("block", F.pmod(F.xxhash64(F.lit(k), key), F.lit(blocks)))
        packed = durable(dealt.groupBy("block").applyInArrow(packer(k > 0), schema), "packed")
        last = k == rounds
        done.append((packed if last else packed.filter(F.col("fill") == capacity)).select(*names, "sequence_id", "offset"))
        rest = packed.filter(F.col("fill") < capacity)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row per piece with its sequence and place."""
    return pack(cut(docs))
