"""Ranked lexical search: MaxScore over an inverted index with pair bounds.

``build_postings`` deals documents to shards and writes one row per shard and term. For
the terms that items ask for, ``impact_lists`` writes each list's impacts and their maximum, and for each pair of terms
that stand next to each other in an item the intersection with its joint maximum. ``search`` reads the lists shard by shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatlane.llm.common import column, text_of
from heatlane.operators.ordered import numbered
from heatlane.session import durable

K = 50
#: A shard closes at so many terms or documents; a longer document is a shard of its own.
SHARD_TERMS, SHARD_DOCS = 1 << 21, 1 << 14
#: Items of a block; one task holds the terms of one block and the lists of one shard.
BLOCK_ITEMS = 1024
#: Shards that one task reads in a row; they share the scores reached so far.
BIN_SHARDS = 4
#: A term's weight, and the saturation of its count, in whole numbers.
WEIGHT, TF_SCALE, TF_STEP, NORM_STEP, NORM_BASE, NORM_SLOPE = 1000.0, 1_000_000_000, 1000, 20, 50, 50

_LETTERS = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
#: UTF-8 bytes: A-Z to a-z, all other ASCII that isn't a letter or digit to a blank.
_TABLE = bytes(c if c in _LETTERS else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of anything beyond ASCII; only A-Z are lowered."""
    return text.translate(_TABLE).split()


def _posting_rows(ids: list, found: list[np.ndarray], vocab: dict[bytes, int], shard: int):
    """Arrow batches of one shard: its documents, then its terms."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    sizes = np.array([len(found[i]) for i in order], dtype=np.int64)
    terms = np.concatenate([found[i] for i in order]).astype(np.int64)
    places = np.repeat(np.arange(len(order)), sizes)
    both, counts = np.unique(terms * len(order) + places, return_counts=True)
    term, doc = both // len(order), (both % len(order)).astype("<i4")
    df = np.bincount(term, minlength=len(vocab))
    offsets = np.concatenate([[0], np.cumsum(df)])
    total = np.add.reduceat(counts, offsets[:-1])

    def blobs(values: np.ndarray) -> pa.Array:
        data = np.ascontiguousarray(values)
        return pa.Array.from_buffers(
            pa.binary(), len(df), [None, pa.py_buffer((offsets * data.itemsize).astype("<i4")), pa.py_buffer(data)]
        )

    names = ["shard", "term", "df", "total", "docs", "counts"]
    known = np.array([ids[i] for i in order if ids[i] is not None], dtype="<i8")
    row = [[shard], [None], [len(order)], [int(sizes.sum())], [known.tobytes()], [sizes.astype("<i8").tobytes()]]
    kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names)
    made = [pa.array(np.full(len(df), shard)), pa.array(list(vocab), pa.binary()), pa.array(df), pa.array(total)]
    whole = pa.RecordBatch.from_arrays([*made, blobs(doc), blobs(counts.astype("<i4"))], names)
    for at in range(0, len(df), 10_000):
        yield whole.slice(at, 10_000)


def build_postings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_terms: int = SHARD_TERMS, shard_docs: int = SHARD_DOCS
) -> DataFrame:
    """The inverted index, written: ``shard``, ``term``, ``df``, ``total``, ``docs``, ``counts``.

    ``docs`` and ``counts`` are little-endian numbers, 32 bits each: places of documents in the shard and
    how often the term stands there. In the row without a term they have 64 bits: the
    documents' ids, ascending (those without id come last and are left out of ``docs``), and numbers of terms.
    Documents without a term are in no shard. A shard never spans two partitions, so nothing is shuffled.
    """

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, found, vocab, n = [], [], {}, 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                words = terms_of(text.as_py())
                if not words:
                    continue
                ids.append(i)
                found.append(np.array([vocab.setdefault(w, len(vocab)) for w in words], dtype=np.int32))
                n += len(words)
                if n >= shard_terms or len(ids) >= shard_docs:
                    yield from _posting_rows(ids, found, vocab, (part << 32) + number)
                    ids, found, vocab, n, number = [], [], {}, 0, number + 1
        if ids:
            yield from _posting_rows(ids, found, vocab, (part << 32) + number)

    given = docs.select(column(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    made = durable(given.mapInArrow(run, "shard long, term binary, df long, total long, docs binary, counts binary"), "postings")
    # numbers without gaps, so that bins of shards are even
    places = numbered(made.filter("term is null").select(F.col("shard").alias("given")), [], ["given"], "place")
    places = durable(places.select("given", (F.col("place") - 1).alias("number")), "shards")
    return made.join(places, made["shard"] == places["given"]).select(F.col("number").alias("shard"), *made.columns[1:])


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item_id, term)."""
    kind = items.select(column(id_col).alias("i")).schema["i"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            owners, terms = [], []
            for place, text in enumerate(batch.column(1).cast(pa.binary())):
                words = set(terms_of(text.as_py()))
                owners += [place] * len(words)
                terms += words
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owners, pa.int64())), pa.array(terms, pa.binary())], ["item_id", "term"])

    given = items.select(column(id_col).alias("item_id"), text_of(text_col).alias("text"))
    return given.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def weighted_items(postings: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``block``, ``item_id``, ``terms`` and ``weights``, the item's terms of weight above 0 that a document holds,
    lightest first. Rows of one item id are one item; a null id is an id like others."""
    n = int(postings.filter("term is null").agg(F.sum("df")).first()[0] or 0)
    wanted = durable(_item_terms(items, id_col, text_col), "item-terms")
    found = postings.join(wanted.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * n + 2.0) / (F.lit(2.0) * F.col("df") + F.lit(1.0))
    weights = found.select("term", F.floor(F.lit(WEIGHT) * F.log(ratio)).alias("w")).filter("w > 0")
    by_item = wanted.join(weights, "term").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("w", "term"))).alias("all"))
    by_item = durable(by_item, "items")
    blocks = max(1, -(-by_item.count() // block_items))
    return by_item.select(
        F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block"), "item_id",
        F.col("all.term").alias("terms"), F.col("all.w").alias("weights"),
    )


def _beside_items(lists: DataFrame, items: DataFrame, bins: int) -> DataFrame:
    """Rows of ``lists`` (with ``block`` and ``shard``) in order of block, bin and shard, in each bin after a copy of the block's items."""
    dealt = lists.withColumn("bin", F.pmod("shard", F.lit(bins)).cast("int"))
    copies = items.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    both = dealt.unionByName(copies, allowMissingColumns=True).repartition("block", "bin")
    return both.sortWithinPartitions("block", "bin", F.asc_nulls_first("shard"), F.asc_nulls_first("term"), F.asc_nulls_first("other"))


def _groups(batches):
    """(block and bin, shard or None for the items, rows as dicts) in the order of ``_beside_items``."""
    key, rows = None, []
    for batch in batches:
        names, columns = batch.schema.names, batch.columns
        for values in zip(*columns, strict=True):
            row = dict(zip(names, values, strict=True))
            here = (row["block"].as_py(), row["bin"].as_py(), row["shard"].as_py())
            if key is not None and here != key:
                yield key[:2], key[2], rows
                rows = []
            key = here
            rows.append(row)
    if rows:
        yield key[:2], key[2], rows


def _numbers(value, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), dtype=kind)


def saturation(counts: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of an impact that does not depend on the term."""
    if NORM_SLOPE * int(lengths.max(initial=0)) * n_docs >= 1 << 63:
        lengths = lengths.astype(object)  # exact beyond a long
    norm = 100 - NORM_BASE + NORM_SLOPE * lengths * n_docs // n_terms
    return (TF_SCALE * counts // (TF_STEP * counts + NORM_STEP * norm)).astype(np.int64)


def _bins(postings: DataFrame) -> int:
    """Bins of ``BIN_SHARDS`` shards each, so that a bin does not grow with the input."""
    return max(1, -(-postings.filter("term is null").count() // BIN_SHARDS))


def impact_lists(postings: DataFrame, items: DataFrame) -> DataFrame:
    """Written lists per block and shard: ``term``, ``other``, ``most``, ``docs``, ``impacts``.

    A row without ``term`` holds the shard's ids in ``docs`` and its number of documents in ``most``. With ``other`` it is the
    intersection of two terms next to each other in an item of the block, with joint impacts and their maximum.
    The number of pairs is below that of the items' terms.
    """
    sums = postings.filter("term is null").agg(F.sum("df"), F.sum("total")).first()
    n_docs, n_terms = int(sums[0] or 0), int(sums[1] or 0)
    asked = items.select("block", F.explode(F.arrays_zip("terms", "weights")).alias("t"))
    asked = asked.select("block", F.col("t.terms").alias("term"), F.col("t.weights").alias("w")).distinct()
    whole = postings.filter("term is null").select("shard", "term", "docs", "counts")
    last = int(items.agg(F.max("block")).first()[0] or 0)
    rows = whole.withColumns({"w": F.lit(None).cast("long"), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))})
    rows = rows.unionByName(postings.select("shard", "term", "docs", "counts").join(asked, "term"))
    kinds = [("block", pa.int64()), ("shard", pa.int64()), ("term", pa.binary()), ("other", pa.binary()), ("most", pa.int64()), ("docs", pa.binary()), ("impacts", pa.binary())]

    def run(batches):
        pairs_of, pairs = None, set()
        for key, shard, rows in _groups(batches):
            if shard is None:
                every = [r["terms"].as_py() for r in rows]
                pairs_of, pairs = key, {p for terms in every for p in zip(terms, terms[1:], strict=False)}
                continue
            if key != pairs_of:  # a block without items
                continue
            lists, lengths, out = {}, None, []
            for r in rows:
                if (term := r["term"].as_py()) is None:
                    lengths = _numbers(r["counts"], "<i8")
                    out.append((key[0], shard, None, None, len(lengths), r["docs"].as_py(), None))
                    continue
                docs = _numbers(r["docs"], "<i4")
                part = saturation(_numbers(r["counts"], "<i4").astype(np.int64), lengths[docs], n_docs, n_terms)
                lists[term] = docs, part * r["w"].as_py()
            out += [(key[0], shard, t, None, int(x.max()), d.tobytes(), x.tobytes()) for t, (d, x) in lists.items()]
            for a, b in sorted(pairs):
                if a in lists and b in lists:
                    docs, x, y = np.intersect1d(lists[a][0], lists[b][0], assume_unique=True, return_indices=True)
                    joint = lists[a][1][x] + lists[b][1][y]
                    out.append((key[0], shard, a, b, int(joint.max(initial=0)), docs.tobytes(), joint.tobytes()))
            for at in range(0, len(out), 1000):
                made = zip(*out[at : at + 1000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, (_, k) in zip(made, kinds, strict=True)], [n for n, _ in kinds])

    both = _beside_items(rows.withColumn("other", F.lit(None).cast("binary")), items, _bins(postings))
    schema = "block long, shard long, term binary, other binary, most long, docs binary, impacts binary"
    return durable(both.mapInArrow(run, schema), "impacts")


class Shard:
    """The lists of one shard: ``lists`` by term and ``pairs`` by two terms, each (docs, impacts, maximum)."""

    def __init__(self, n_docs: int, lists: dict, pairs: dict):
        self.lists, self.pairs, self.sums = lists, pairs, np.zeros(n_docs, dtype=np.int64)
        self.levels: dict = {}

    def level(self, of: dict, key, k: int) -> int:
        """The kth greatest impact of a list: so much has the kth document of any query with these terms."""
        if (key, k) not in self.levels:
            x = of[key][1]
            self.levels[key, k] = int(np.partition(x, len(x) - k)[len(x) - k]) if len(x) >= k else 0
        return self.levels[key, k]

    def bounds(self, terms: list[bytes]) -> tuple[list[int], list[int]]:
        """For each i the most that the first i terms together can add, by the best mix of single maxima and
        bounds of pairs, and how many terms the last step of that mix takes."""
        best, step = [0], [0]
        for i, t in enumerate(terms):
            single, pair = best[i] + self.lists[t][2], None
            if i and (p := self.pairs.get((terms[i - 1], t))) is not None:
                pair = best[i - 1] + max(p[2], self.lists[terms[i - 1]][2], self.lists[t][2])
            best.append(single if pair is None else min(single, pair))
            step.append(1 if pair is None or single <= pair else 2)
        return best, step

    def search(self, asked: list[bytes], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the shard's ``k`` best documents of at least ``floor``, best first, equal scores by place, and the
        number of impacts read. ``asked`` are the item's terms, lightest first.

        Terms are read from the heaviest. Once the rest cannot lift an unseen document to the kth score known so far, no
        further one is admitted; those admitted are dropped as soon as their sum and the bound of the rest stay below it.
        """
        terms = [t for t in asked if t in self.lists]
        best, step = self.bounds(terms)
        none = np.zeros(0, dtype=np.int64)
        if not terms or best[-1] < max(floor, 1):
            return none, none, 0
        level = max(floor, 1, *(self.level(self.lists, t, k) for t in terms))
        level = max([level, *(self.level(self.pairs, p, k) for p in zip(terms, terms[1:], strict=False) if p in self.pairs)])
        sums, read, left = self.sums, 0, len(terms)
        sums[:] = 0
        while left and best[left] >= level:
            left -= 1
            docs, impacts, _ = self.lists[terms[left]]
            sums[docs] += impacts
            read += len(docs)
            if len(sums) > k and ((len(terms) - left) & 3 == 0 or best[left] < 2 * level):
                level = max(level, int(np.partition(sums, len(sums) - k)[len(sums) - k]))
        found = np.flatnonzero(sums + best[left] >= level)
        found = found[sums[found] > 0]  # no further document is admitted, so the bound of the rest is below the level
        scores = sums[found]
        if left and len(found) > k:
            hope, i = scores.copy(), left
            while i:  # what each document can still get: from a pair the joint maximum only where both terms stand
                if step[i] == 2:
                    a, b = terms[i - 2], terms[i - 1]
                    docs, _, most = self.pairs[a, b]
                    hope += np.where(_places(docs, found) >= 0, most, max(self.lists[a][2], self.lists[b][2]))
                else:
                    hope += self.lists[terms[i - 1]][2]
                i -= step[i]
            found, scores = found[hope >= level], scores[hope >= level]
        while left:
            left -= 1
            docs, impacts, _ = self.lists[terms[left]]
            at = _places(docs, found)
            scores = scores + np.where(at >= 0, impacts[np.maximum(at, 0)], 0)
            read += len(found)
            if len(found) > k:
                level = max(level, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
            keep = scores + best[left] >= level
            found, scores = found[keep], scores[keep]
        keep = scores >= level
        found, scores = found[keep], scores[keep]
        order = np.lexsort((found, -scores))[:k]
        return found[order], scores[order], read


def _places(docs: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Where each of ``found`` stands in the ascending ``docs``; -1 if it does not."""
    at = np.minimum(np.searchsorted(docs, found), len(docs) - 1) if len(docs) else np.zeros(len(found), dtype=np.int64)
    return np.where(docs[at] == found, at, -1) if len(docs) else at - 1


def search(lists: DataFrame, items: DataFrame, bins: int, k: int = K) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of each item over all shards.

    The kth score of an item is carried from shard to shard of a bin, so a later shard starts with its bound.
    """
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches):
        bin_key, asked, top = None, [], []

        def out():
            rows = [(i, d, -s) for (i, _), found in zip(asked, top, strict=True) for s, _, d in found]
            ids, docs, scores = zip(*rows, strict=True) if rows else ((), (), ())
            owners = pa.array(ids, item_type[0])
            return pa.RecordBatch.from_arrays([owners, pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

        item_type = [None]
        for key, shard, rows in _groups(batches):
            if shard is None:
                if bin_key is not None:
                    yield out()
                item_type[0] = rows[0]["item_id"].type
                asked = [(r["item_id"].as_py(), r["terms"].as_py()) for r in rows]
                bin_key, top = key, [[] for _ in asked]
                continue
            if key != bin_key:  # a block without items
                continue
            ids, n_docs, singles, pairs = None, 0, {}, {}
            for r in rows:
                if r["term"].as_py() is None:
                    ids, n_docs = _numbers(r["docs"], "<i8"), r["most"].as_py()
                    continue
                entry = _numbers(r["docs"], "<i4"), _numbers(r["impacts"], "<i8"), r["most"].as_py()
                if (other := r["other"].as_py()) is None:
                    singles[r["term"].as_py()] = entry
                else:
                    pairs[r["term"].as_py(), other] = entry
            here = Shard(n_docs, singles, pairs)
            for q, (_, terms) in enumerate(asked):
                floor = -top[q][-1][0] if len(top[q]) == k else 0
                found, scores, _ = here.search(terms, k, floor)
                # places ascend by id, null ids last; so does this order
                new = [(-s, int(d >= len(ids)), int(ids[d]) if d < len(ids) else None) for d, s in zip(found.tolist(), scores.tolist(), strict=True)]
                top[q] = heapq.nsmallest(k, [*top[q], *new], key=lambda x: (x[0], x[1], x[2] or 0))
        if bin_key is not None:
            yield out()

    found = _beside_items(lists, items, bins).mapInArrow(run, f"item_id {kind}, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", block_items: int = BLOCK_ITEMS, **sizes) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: for each item the ``k`` documents of highest score above 0.

    Null and empty texts have no term and rank nowhere; texts of any length are read whole. Equal scores go by
    ascending id, documents without an id last. Each row is a document of its own, also where ids or whole rows
    repeat. Rows of one item id are one item with all their terms; items without a term that any document
    holds have no row. Empty tables give an empty result. Other columns are not read.
    """
    postings = build_postings(docs, doc_id, text_col, **sizes)
    weighted = durable(weighted_items(postings, items, item_id, text_col, block_items), "weighted")
    return search(impact_lists(postings, weighted), weighted, _bins(postings), k)
