"""Near-dedup: SimHash by meet-in-the-middle ball hashing, and real similarity by verified min-hash buckets."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import column, restored, text_of, whole_row
from heatlane.session import durable

SHINGLE, SEED, RADIUS, BITS = 3, 42, 2, 64
#: The pipeline stage: words a shingle, and the least Jaccard similarity as a fraction.
WORDS, LEAST = 5, (8, 10)
#: Min-hashes meet in BANDS buckets of ROWS each: a pair of similarity s is missed with probability (1 - s**ROWS) ** BANDS.
BANDS, ROWS = 24, 4
#: Members of buckets that still hold several groups are dealt anew, level by level, to parts of their bucket: (parts for each
#: membership, further min-hashes that a part's members share). Where at most FEW members are outside the largest
#: group of a bucket, each of them is compared with all. What the levels leave apart is compared by rare shingles.
LEVELS, FEW = ((1, 2), (3, 3), (3, 3)), 6
#: Shingle hashes whose bits are counted at once.
_SLICE = 1 << 15


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and ASCII white space only


def _shingles(words: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """64-bit hashes of all shingles, repeats included; fewer words are one shingle."""
    size = min(shingle, len(words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    stops = (starts + lengths)[size - 1 :]
    joined = b" ".join(words)
    n = len(words) - size + 1
    return np.fromiter(
        (xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), stops.tolist())), dtype=np.uint64, count=n
    )


def simhash(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if set in over half the shingle hashes, repeats included.

    A-Z in lower case, words between ASCII white space; a shorter text is one
    shingle, and a text without words has fingerprint 0.
    """
    words = _words(text)
    return _print_of(_shingles(words, shingle, seed)) if words else 0


def _print_of(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes."""
    n = len(hashes)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _SLICE):
        raw = hashes[at : at + _SLICE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > n)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id`` and ``fp``, the 64 bits as a signed long."""
    kind = docs.select(column(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = np.array([simhash(t.as_py(), shingle, seed) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    given = docs.select(column(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return given.mapInArrow(run, f"doc_id {kind}, fp long")


def _masks(bits: int) -> list[int]:
    """All 64-bit values of at most ``bits`` bits, as signed longs."""
    found = [sum(1 << k for k in ks) for n in range(bits + 1) for ks in combinations(range(BITS), n)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in found]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b), a > b, between different fingerprints, that connect all that
    differ in at most ``radius`` bits, an even number.

    Every fingerprint emits itself and its variants within half the radius, 64 at
    one bit. Two fingerprints within the radius of each other share a variant, and
    two that share one are within the radius. So those that meet at a variant
    are all linked with each other: it is enough to link each with the
    least of them. Distances are verified all the same.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even")
    masks = _masks(radius // 2)
    variants = [F.col("fp").bitwiseXOR(F.lit(m)) for m in masks]
    balls = fps.select("fp", F.explode(F.array(*variants)).alias("v"))
    met = balls.groupBy("v").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count(F.lit(1)).alias("n"))
    met = durable(met.filter(F.col("n") > 1), "met")
    pairs = met.select(F.col("high").alias("a"), F.col("low").alias("b"))
    # Where more than two meet, the fingerprints between the least and the greatest are looked up around the variant.
    center = [F.col("v").bitwiseXOR(F.lit(m)) for m in masks]
    around = met.filter(F.col("n") > 2).select("low", F.explode(F.array(*center)).alias("fp"))
    between = around.join(fps, "fp").select(F.col("fp").alias("a"), F.col("low").alias("b")).filter(F.col("a") != F.col("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    return pairs.unionByName(between).filter(close).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b), a > b; root is the least node
    reachable. Alternates the two star steps: each node passes its larger
    neighbours, then its smaller ones, on to the least neighbour it knows, until
    nothing changes. Minima are combined before the shuffle, and a large star is a
    skewed join that Spark can split. Every round is written to the shared folder.
    """

    def seen(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("m"))

    edges = durable(edges, "edges")
    before = seen(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lows = durable(least(both).withColumn("m", F.least("m", "a")), "lows")
        large = both.filter(F.col("b") > F.col("a")).join(lows, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = durable(large.filter(F.col("a") > F.col("b")).distinct(), "large")
        lows = durable(least(large), "lows")
        small = large.join(lows, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = durable(small.select("e.a", "e.b").filter(F.col("a") > F.col("b")).distinct(), "edges")
        now = seen(edges)
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the least id
    reachable over links of at most ``radius`` differing bits; one row per input row.

    Null and empty texts have fingerprint 0 and link like others. Rows of one id
    each link by their own text; null ids are members but never a component's
    name, unless all are null. An empty table gives an empty result. Documents of
    one fingerprint are reduced to it before any link is sought, so exact copies
    cost nothing.
    """
    marked = durable(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    by_print = durable(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(links(by_print.select("fp"), radius))
    rooted = by_print.join(roots, by_print["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = durable(rooted, "rooted")
    named = durable(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    of_print = durable(rooted.join(named, "root").select("fp", "component_id"), "components")
    return marked.join(of_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def min_hashes(hashes: np.ndarray, seed: int, bands: int = BANDS, rows: int = ROWS) -> list[int]:
    """One signed 64-bit bucket per band, each over ``rows`` min-hashes of the shingles."""
    keys = np.random.default_rng(seed).integers(0, 1 << 64, (2, bands * rows), dtype=np.uint64)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 1 << 10):
        mixed = (hashes[at : at + (1 << 10), None] ^ keys[0]) * (keys[1] | np.uint64(1))
        np.minimum(least, mixed.min(axis=0), out=least)
    found = [xxhash.xxh64_intdigest(part.tobytes(), band) for band, part in enumerate(least.astype("<u8").reshape(bands, rows))]
    return np.array(found, dtype=np.uint64).view(np.int64).tolist()


def _signed(rows: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``key`` (128 bits of the words), ``n`` (different shingles), ``fp`` (the fingerprint) and ``buckets`` beside all columns but
    ``text``. Texts shorter than a shingle equal nothing but their own words and have neither fingerprint nor bucket."""
    kept = [c for c in rows.columns if c != "text"]

    def run(batches):
        for batch in batches:
            keys, sizes, prints, buckets = [], [], [], []
            for t in batch.column("text"):
                words = _words(t.as_py())
                every = _shingles(words, shingle, seed) if len(words) >= shingle else ()
                hashes = np.unique(every)
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                sizes.append(len(hashes))
                prints.append(_print_of(every) if len(hashes) else None)
                buckets.append(min_hashes(hashes, seed) if len(hashes) else [])
            made = [batch.column(c) for c in kept]
            made += [pa.array(keys, pa.binary()), pa.array(sizes, pa.int32())]
            made += [pa.array(prints, pa.uint64()).view(pa.int64()), pa.array(buckets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, [*kept, "key", "n", "fp", "buckets"])

    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept]
    return rows.mapInArrow(run, ", ".join([*kinds, "key binary", "n int", "fp long", "buckets array<long>"]))


def _shingle_sets(texts: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``node`` and its different shingle hashes, ascending, as bytes."""

    def run(batches):
        for batch in batches:
            sets = [np.unique(_shingles(_words(t.as_py()), shingle, seed)).astype("<u8").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    return texts.select("node", "text").mapInArrow(run, "node long, shingles binary")


def _verified(pairs: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the Jaccard similarity ``least``."""
    num, den = least

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                u, v = (np.frombuffer(z.as_buffer(), dtype="<u8") for z in (x, y))
                common = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(common * den >= (len(u) + len(v) - common) * num)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def similar_rows(
    rows: DataFrame, shingle: int = WORDS, least: tuple[int, int] = LEAST, seed: int = SEED
) -> DataFrame:
    """``row``, ``doc_id`` and ``root`` for a written table of ``row`` (different longs), ``doc_id`` and
    ``text``; rows share a root if chains of pairs with a Jaccard similarity of ``least`` or more join them.

    Rows of the same words are one node. Nodes whose SimHash fingerprints differ in at most ``RADIUS`` bits are candidates, and so
    are those that share a bucket of min-hashes, as 64 bits tell only the closest texts; no
    link is made before their sets of shingles were compared. Each member of a bucket is compared with one of them, another
    one in each bucket; where at most ``FEW`` members are then outside the largest group of a bucket, they are compared with all others. Members of
    buckets with more are dealt to parts of the bucket by further min-hashes, and again, at most once per entry of ``LEVELS``: that joins most
    groups by comparisons in proportion to the members. Members of these buckets that are in different groups even then are compared
    wherever the rarest shingles of two allow the similarity, so no pair of a bucket is left out. Texts without words are alike.
    """
    marked = durable(_signed(rows, shingle, seed), "signed")
    nodes = durable(marked.groupBy("key").agg(F.min("row").alias("node"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("buckets").alias("buckets")), "nodes")
    close = durable(_close_prints(nodes, least), "close")
    members = durable(_first_of(nodes.select("node", "n", F.col("node").alias("root"), F.posexplode("buckets").alias("band", "v"))), "members")
    asked = members.select("node").unionByName(close.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
    texts = rows.join(asked.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "text")
    sets = durable(_shingle_sets(texts, shingle, seed), "shingles")
    tried = durable(close.unionByName(_with_first(members, least)).distinct(), "tried")
    edges = durable(_verified(tried, sets, least), "similar")
    roots = components(edges)
    bands, split = BANDS, None
    for level, (parts, shared) in enumerate((*LEVELS, (0, 0)), 1):
        few, many = _split(members, roots)
        split = many if split is None else split
        pairs = _with_all(few, least)
        if more_to_deal := parts > 0 and not many.isEmpty():
            members = durable(_first_of(_dealt(many, sets, seed + level, bands, parts, shared)), "members")
            bands *= parts
            pairs = pairs.unionByName(_with_first(members, least)).distinct()
        pairs = durable(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        more = durable(_verified(pairs, sets, least), "similar")
        if not more.isEmpty():
            edges = edges.unionByName(more)
            roots = components(edges)
        tried = tried.unionByName(pairs)
        if not more_to_deal:
            break
    apart = _apart(split, roots)
    if not apart.isEmpty():
        pairs = durable(_by_rare_shingles(apart, sets, least).join(tried, ["a", "b"], "left_anti"), "pairs")
        roots = components(edges.unionByName(durable(_verified(pairs, sets, least), "similar")))
    of_key = nodes.select("key", "node").join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root"))
    return marked.select("row", "doc_id", "key").join(durable(of_key, "roots"), "key").select("row", "doc_id", "root")


def _close_prints(nodes: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Pairs (a, b), a > b, of nodes by their fingerprints: each with the first node of its fingerprint, and the first nodes of linked ones."""
    own = nodes.filter(F.col("fp").isNotNull()).select("fp", "node", "n")
    first = own.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("f")).select("fp", F.col("f.node").alias("f_node"), F.col("f.n").alias("f_n"))
    first = durable(first, "prints")
    fits, pair = _pair(F.col("n"), F.col("f_n"), F.col("node"), F.col("f_node"), least)
    alike = own.join(first, "fp").filter((F.col("node") != F.col("f_node")) & fits).select(*pair)
    one, two = (first.select(F.col("fp").alias(c), F.struct("f_node", "f_n").alias(f"{c}_f")) for c in "ab")
    linked = durable(links(first.select("fp")), "links").join(one, "a").join(two, "b")
    fits, pair = _pair(F.col("a_f.f_n"), F.col("b_f.f_n"), F.col("a_f.f_node"), F.col("b_f.f_node"), least)
    return alike.unionByName(linked.filter(fits).select(*pair))


def _first_of(dealt: DataFrame) -> DataFrame:
    """Members (v, band, node, n, root) of buckets with two roots or more, beside the first of their bucket in an order that differs by bucket."""
    order = F.struct(F.xxhash64("v", "node"), F.col("node"), F.col("n"), F.col("root"))
    met = dealt.groupBy("v").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min(order).alias("first"))
    met = met.filter(F.col("low") < F.col("high")).select("v", F.col("first.node").alias("f_node"), F.col("first.n").alias("f_n"), F.col("first.root").alias("f_root"))
    return dealt.join(durable(met, "met"), "v")


def _pair(n: Column, other_n: Column, node: Column, other: Column, least: tuple[int, int]) -> tuple[Column, list[Column]]:
    """Whether sizes allow the similarity, and the pair as (a, b), a > b."""
    num, den = least
    return (n * den >= other_n * num) & (other_n * den >= n * num), [F.greatest(node, other).alias("a"), F.least(node, other).alias("b")]


def _with_first(members: DataFrame, least: tuple[int, int]) -> DataFrame:
    """Each member with the first of its bucket, where they are in different groups."""
    fits, pair = _pair(F.col("n"), F.col("f_n"), F.col("node"), F.col("f_node"), least)
    return members.filter((F.col("root") != F.col("f_root")) & fits).select(*pair).distinct()


def _with_all(few: DataFrame, least: tuple[int, int]) -> DataFrame:
    """The members outside the largest group of their bucket, at most FEW, with all of a different group."""
    listed = few.filter(F.col("root") != F.col("top")).groupBy("v").agg(F.array_sort(F.collect_list(F.struct("node", "n", "root"))).alias("others"))
    two = few.join(durable(listed, "others"), "v").select("node", "n", "root", F.explode("others").alias("y"))
    fits, pair = _pair(F.col("n"), F.col("y.n"), F.col("node"), F.col("y.node"), least)
    return two.filter((F.col("root") != F.col("y.root")) & fits).select(*pair).distinct()


def _split(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members of buckets that still hold different groups, without the first ones, which all others were
    compared with: those of buckets with few members outside the largest group, ``top``, and those of others."""
    rest = members.filter(F.col("node") != F.col("f_node")).select("v", "band", "node", "n")
    rest = durable(rest.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "members")
    sizes = rest.groupBy("v", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("v")
    sizes = sizes.agg(F.sum("size").alias("size"), F.max(F.struct("size", "root")).alias("top"))
    sizes = sizes.select("v", (F.col("size") - F.col("top.size")).alias("outside"), F.col("top.root").alias("top")).filter(F.col("outside") > 0)
    still = rest.join(durable(sizes, "split"), "v")
    return still.filter(F.col("outside") <= FEW), still.filter(F.col("outside") > FEW)


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``node`` and ``root`` of the members of buckets that hold different groups now."""
    now = members.select("v", "node").join(roots, "node", "left").select("v", "node", F.coalesce("root", "node").alias("root"))
    now = durable(now, "members")
    met = now.groupBy("v").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter(F.col("low") < F.col("high"))
    return durable(now.join(durable(met.select("v"), "split"), "v").select("node", "root").distinct(), "apart")


def _by_rare_shingles(apart: DataFrame, sets: DataFrame, least: tuple[int, int]) -> DataFrame:
    """All pairs (a, b), a > b, of nodes of different groups that can reach the similarity ``least``.

    Shingles have one order: those of a single group first, then by the number of their nodes. Of two similar sets, each must hold a common
    one among its first: as many as may be missing in the other, and one. The sum of those they have in common there and of all that
    follow must reach what the similarity asks for. So a pair is compared only if it shares shingles that few others have.
    """
    num, den = least

    def each(batches):
        for batch in batches:
            found = [np.frombuffer(x.as_buffer(), dtype="<i8") for x in batch.column(2)]
            sizes = [len(x) for x in found]
            made = [np.repeat(batch.column(c).to_numpy(), sizes) for c in (0, 1)] + [np.repeat(sizes, sizes), np.concatenate(found)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in made], ["node", "root", "n", "s"])

    every = sets.join(apart, "node").select("node", "root", "shingles").mapInArrow(each, "node long, root long, n long, s long")
    every = durable(every, "every")
    held = every.groupBy("s").agg(F.count(F.lit(1)).alias("f"), F.min("root").alias("low"), F.max("root").alias("high"))
    held = durable(held.filter(F.col("low") < F.col("high")).select("s", "f"), "held")
    first = F.col("n") - F.ceil(F.col("n") * num / den) + 1
    common = every.join(held, "s")
    seen = common.groupBy("node").agg(F.first("root").alias("root"), F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("f", "s"))).alias("order"))
    # those of one group come before all others: they take places, but meet nobody
    alone = (F.col("n") - F.size("order")).cast("int")
    asked = seen.withColumn("alone", alone).withColumn("first", first).filter(F.col("first") > F.col("alone"))
    asked = asked.select("node", "root", "n", "first", "alone", F.posexplode(F.slice("order", F.lit(1), (F.col("first") - F.col("alone")).cast("int"))).alias("at", "o"))
    asked = durable(asked.select("node", "root", "n", "first", (F.col("alone") + F.col("at")).alias("at"), F.col("o.s").alias("s")), "rare")
    one, two = (asked.select("s", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "root", "n", "first", "at")]) for x in "ab")
    fits, pair = _pair(F.col("n_a"), F.col("n_b"), F.col("node_a"), F.col("node_b"), least)
    met = one.join(two, "s").filter((F.col("node_a") > F.col("node_b")) & (F.col("root_a") != F.col("root_b")) & fits)
    rest = F.greatest(F.max(F.col("n_a") - F.col("first_a")), F.max(F.col("n_b") - F.col("first_b")))
    behind = F.least(F.max(F.col("n_a") - F.col("at_a")), F.max(F.col("n_b") - F.col("at_b")))
    need = (F.max(F.col("n_a") + F.col("n_b"))) * num
    bound = F.least(F.count(F.lit(1)) + rest, behind) * (num + den)
    return met.groupBy(*pair).agg(bound.alias("bound"), need.alias("need")).filter(F.col("bound") >= F.col("need")).select("a", "b")


def _dealt(members: DataFrame, sets: DataFrame, seed: int, bands: int, parts: int, shared: int) -> DataFrame:
    """Each membership in ``parts`` parts of its bucket, one of ``bands`` of its node; the members of a part have ``shared`` further
    min-hashes in common. Every band has min-hashes of its own, so a node has one row for each part, not one for each band there is."""

    def run(batches):
        for batch in batches:
            keys = [min_hashes(np.frombuffer(x.as_buffer(), dtype="<u8"), seed, bands * parts, shared) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["node", "keys"])

    nodes = members.select("node").distinct()
    keys = sets.join(nodes, "node").select("node", "shingles").mapInArrow(run, "node long, keys array<long>")
    own = F.slice("keys", F.col("band") * parts + 1, parts)
    made = members.join(durable(keys, "keys"), "node").select("v", "band", "node", "n", "root", F.posexplode(own).alias("part", "key"))
    return durable(made.select("node", "n", "root", (F.col("band") * parts + F.col("part")).alias("band"), F.xxhash64("v", "key").alias("v")), "dealt")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of similar texts (five-word shingles, Jaccard 0.8) the rows of the least
    id. A row goes for its own text only, also where its id is repeated; repeated rows of the least id stay.
    Rows without an id go if one of their group has an id; else one of them stays."""
    whole = durable(docs.select(whole_row(docs), F.monotonically_increasing_id().alias("number")), "rows")
    given = whole.select(F.col("number").alias("row"), F.col("row.doc_id").alias("doc_id"), F.coalesce(F.col("row.text"), F.lit("")).alias("text"))
    found = durable(similar_rows(given), "groups")
    named = found.groupBy("root").agg(F.min("doc_id").alias("least"), F.min("row").alias("first"), F.count(F.lit(1)).alias("size"))
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.col("least").isNotNull() | (F.col("row") > F.col("first")))
    gone = found.join(durable(named.filter(F.col("size") > 1), "named"), "root").filter(later).select(F.col("row").alias("_gone"))
    gone = durable(gone, "gone")
    return restored(whole.join(gone, whole["number"] == gone["_gone"], "left_anti"), docs)
