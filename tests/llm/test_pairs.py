"""Top-k search, substring dedup and near-dedup against brute force."""

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from heatlane.llm import near_dedup, queries, substring_dedup, topk_search
from tests.llm.samples import STORY, documents, empty, folder_of, split_words, texts


# --- substring dedup


def plain_repeats(rows, window=50):
    first = {}
    for i, t in rows:
        ws = split_words(t)
        for s in range(len(ws) - window + 1):
            k = tuple(ws[s : s + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        ws = split_words(t)
        gone = [False] * len(ws)
        for s in range(len(ws) - window + 1):
            if i is not None and first[tuple(ws[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        out.append((i, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone, strict=True) if not g)))
    return out


def mosaics():
    """Documents out of shared passages of many lengths, around the window's length."""
    rng = np.random.default_rng(7)
    passage = [[f"p{k}w{rng.integers(40)}" for _ in range(n)] for k, n in enumerate((49, 50, 51, 70, 120, 400, 16, 30))]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.integers(1, 5)):
            p = passage[rng.integers(len(passage))]
            a = int(rng.integers(0, max(1, len(p) - 45))) if rng.random() < 0.4 else 0
            words += p[a:] + [f"own{i}x{rng.integers(30)}" for _ in range(int(rng.integers(0, 60)))]
            if rng.random() < 0.2:
                words[int(rng.integers(len(words)))] = "edit"
        rows.append((int(rng.permutation(1000)[0]) * 1000 + i, (" " if i % 3 else "\n").join(words)))
    return rows


@pytest.mark.parametrize("rows", [texts(), mosaics()], ids=["odd", "mosaics"])
def test_substring_dedup(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = Counter(tuple(r) for r in substring_dedup.remove_repeats(df).collect())
    want = plain_repeats(rows)
    assert got == Counter(want) and sum(w[2] for w in want) > 100


def test_substring_digest_and_extra_columns(spark):
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(documents(spark), digest=True).collect() if r.doc_id in (10, 12)}
    assert got[12].n_removed == 300 and got[12].kept == hashlib.sha256(b"").hexdigest()
    assert got[10].n_removed == 0 and got[10].kept == hashlib.sha256(STORY.encode()).hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=120), st.integers(1, 40))
def test_least_places(values, width):
    v = np.array(values, dtype=np.uint64)
    got = substring_dedup._least_places(v, width) if len(v) >= width else []
    want = [max(j for j in range(s, s + width) if v[j] == v[s : s + width].min()) for s in range(len(v) - width + 1)]
    assert list(got) == want


def test_automaton_is_exact():
    a = substring_dedup.Automaton({("a b c", 3), ("b c", 9), ("a b c", 5)})
    assert a.covered("x a b c b c".split(), 4).tolist() == [False, True, True, True, False, False]
    assert a.covered("x a b c b c".split(), 10).tolist() == [False, True, True, True, True, True]
    assert not a.covered("a b".split(), 9).any() and not substring_dedup.Automaton(()).covered(["a"], 1).any()


# --- SimHash


def plain_simhash(text):
    ws = [w.lower() if w.isascii() else "".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in split_words(text)]
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(prints):
    """prints: (id, fingerprint) rows; the least id linked to each row."""
    n = len(prints)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(n):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        r = find(k)
        least[r] = i if least.get(r) is None else min(least[r], i if i is not None else least[r])
    return [(i, format(f, "016x"), least[find(k)]) for k, (i, f) in enumerate(prints)]


def test_near_dedup(spark):
    got = Counter(tuple(r) for r in near_dedup.near_duplicates(documents(spark)).collect())
    assert got == Counter(plain_components([(i, plain_simhash(t)) for i, t in texts()]))


def test_chains_stars_and_hubs_of_fingerprints(spark):
    """Links are transitive and none is lost where many fingerprints meet at a variant."""
    rng = np.random.default_rng(3)
    prints = [0, 1 << 63, (1 << 64) - 1]
    prints += [1 << k for k in range(64)]  # all within two bits of each other, around 0
    chain = 0xABCDEF0123456789
    for k in range(40):  # a long chain
        chain ^= (1 << k) | (1 << (63 - k))
        prints.append(chain)
    prints += [int(x) for x in rng.integers(0, 2**63, 200)]
    prints += [p ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) for p in prints[-60:]]
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    fps = spark.createDataFrame([(p,) for p in signed], "fp long")
    roots = {r.node: r.root for r in near_dedup.components(near_dedup.links(fps)).collect()}
    got = {}
    for p in signed:
        got.setdefault(roots.get(p, p), set()).add(p)
    want = {}
    for (_, f, r), p in zip(plain_components(list(enumerate(prints))), signed, strict=True):
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_dedup_stage(spark):
    docs = documents(spark)
    out = near_dedup.stage(spark, docs, "")
    ids = Counter(r.doc_id for r in out.collect())
    assert out.columns == docs.columns and 12 not in ids and ids[10] == 1 and ids[7] == 1 and 8 not in ids and ids[23] == 2


def plain_similar(rows, least=(8, 10)):
    """The least id of each row's group by five-word Jaccard, over all pairs; rows: (id, text)."""

    def shingles(t):
        ws = (t or "").encode().lower().split()
        size = min(5, len(ws))
        return {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)} if ws else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for a, s in enumerate(sets):
        near = Counter(b for g in s for b in holders.get(g, ()))
        for b, common in near.items():
            if common * least[1] >= (len(s) + len(sets[b]) - common) * least[0]:
                root[find(a)] = find(b)
        for g in s or {None}:
            holders.setdefault(g, []).append(a)
        if not s:
            root[find(a)] = find(holders[None][0])
    named = {}
    for k, (i, _) in enumerate(rows):
        named.setdefault(find(k), []).append(i)
    return [min((i for i in named[find(k)] if i is not None), default=None) for k in range(len(rows))]


def near_copies():
    """Texts with some words replaced, so that similarities lie on both sides of 0.8, chains of them, and a large group."""
    rng = np.random.default_rng(11)
    rows = []
    for base in range(60):
        words = [f"b{base}w{rng.integers(200)}" for _ in range(int(rng.integers(5, 400)))]
        for _ in range(60 if base == 0 else 4):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            for _ in range(int(rng.integers(0, 2 + len(words) // 30))):
                words[int(rng.integers(len(words)))] = f"e{len(rows)}"
    return rows


def test_near_dedup_stage_takes_real_similarity(spark):
    rows = [(5000 + k if i is None else i + 1000, t) for k, (i, t) in enumerate(texts())] + near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = Counter((i, t) for (i, t), least in zip(rows, plain_similar(rows), strict=True) if i == least)
    assert Counter(tuple(r) for r in near_dedup.stage(spark, df, "").collect()) == want
    assert 20 < len(want) < len(rows) - 100


def test_near_dedup_stage_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    want = {i for (i, _), least in zip(rows, plain_similar(rows), strict=True) if i == least}
    assert {r.doc_id for r in near_dedup.stage(spark, df, "").collect()} == want


def families(n_families, size, seed=5):
    """Pages of one template: families share most words, but only members of a family reach 0.8; every fourth family has a bridge to the next."""
    rng = np.random.default_rng(seed)
    page = [f"t{i}" for i in range(120)]
    rows = []
    for f in range(n_families):
        own = list(page)
        own[100:] = [f"f{f}x{i}" for i in range(20)]
        for k in range(size):
            words = list(own)
            if k:
                words[int(rng.integers(100))] = f"c{k % 7}"
            rows.append((len(rows), " ".join(words)))
        if f % 4 == 0:
            rows.append((len(rows), " ".join([*own[:110], *[f"f{f + 1}x{i}" for i in range(10, 20)]])))
    return rows


def test_pairs_grow_with_the_members_of_a_bucket(spark, monkeypatch):
    """One template on many pages in several groups: comparisons in proportion to rows, groups as by all pairs."""
    plain = near_dedup._verified
    counts = {}
    for size in (60, 240):
        rows = families(8, size)
        tried = []
        monkeypatch.setattr(near_dedup, "_verified", lambda pairs, *a, t=tried: (t.append(pairs.count()), plain(pairs, *a))[1])
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        kept = {r.doc_id for r in near_dedup.stage(spark, df, "").collect()}
        counts[size] = sum(tried) / len(rows)
        if size == 60:
            assert kept == {i for (i, _), least in zip(rows, plain_similar(rows), strict=True) if i == least}
        assert 2 <= len(kept) <= 8
    assert counts[240] < 1.5 * counts[60]


def test_near_dedup_stage_decides_by_row(spark):
    rows = [(3, "x " * 9), (7, "x " * 9), (7, "another text"), (None, "x " * 9), (None, "no id"), (None, "no id"), (None, "alone")]
    got = near_dedup.stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert Counter(map(tuple, got)) == Counter([rows[0], rows[2], rows[4], rows[6]])


def test_near_duplicates_take_parameters(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(57)) + " x y z"
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    far = (near_dedup.simhash(a, 5, 7) ^ near_dedup.simhash(b, 5, 7)).bit_count()
    assert far > 2
    for radius, n in ((2, 2), (4, 1 if far <= 4 else 2)):
        got = near_dedup.near_duplicates(df, shingle=5, radius=radius, seed=7).collect()
        assert {r.fingerprint for r in got} == {format(near_dedup.simhash(t, 5, 7), "016x") for t in (a, b)}
        assert len({r.component_id for r in got}) == n


# --- top-k


def plain_top_k(vectors, k=20, every=20):
    fine = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(64 * x) for x in v]
            fine[i] = min(fine.get(i, q), q)
    out = []
    for i, q in fine.items():
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in fine.items() if j != i)[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return out


def awkward_vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).round(2).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 8) for i in range(300, 380)]  # ties
    rows += [(400, None), (420, [1.0, None]), (440, [float("nan")] * 8), (460, [float("inf")] * 8), (None, [1.0] * 8), (480, [])]
    return [*rows, (500, [0.25] * 3), (20, [9.0] * 8), (0, rows[0][1])]


def test_top_k_over_several_shards(spark):
    rows = awkward_vectors()
    v = topk_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).cache()
    out = topk_search.top_k(v, v.filter(topk_search.is_query()), shard_rows=50, block_queries=7)
    assert sorted(map(tuple, out.collect())) == sorted(plain_top_k(rows))


def test_wide_components_of_top_k(spark):
    """Finite components of any size are scored exactly; only a result that fits no long stops the job."""
    rows = [(i, v) for i, v in awkward_vectors() if i is not None and i < 60]
    rows += [(1001, [1e17, 50.0]), (1002, [1e16, -1e16 + 2048]), (1003, [0.0, 1e14]), (1020, [0.0, 1.0]), (1040, [0.0, 0.0, 1e12])]

    def found(rows):
        v = topk_search.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        return topk_search.top_k(v, v.filter("vec_id in (1020, 1040)"), shard_rows=20)

    want = [r for r in plain_top_k(rows) if r[0] in (1020, 1040)]
    assert sorted(map(tuple, found(rows).collect())) == sorted(want)
    assert (1020, 2, 1001, 204_800) in want
    with pytest.raises(Exception, match="does not fit a long"):
        found([*rows, (1004, [0.0, 1e17])]).collect()


def test_top_k_stops_early():
    """With one strong dimension the bound falls below the kth score long before the lists end."""
    n = 4000
    rows = np.zeros((n, 4), dtype=np.int64)
    rows[:, 0] = np.arange(n)
    orders = np.argsort(rows, axis=0, kind="stable").T.astype(np.int32)
    seen = []
    product = topk_search._product
    topk_search._product = lambda q, r, e: (seen.append(len(r)), product(q, r, e))[1]
    try:
        q, ids, scores = topk_search.threshold_search(np.arange(n), rows, orders, np.array([-1]), np.array([[1, 0, 0, 0]]), 5)
    finally:
        topk_search._product = product
    assert ids.tolist() == [3999, 3998, 3997, 3996, 3995] and sum(seen) < 400


def test_few_candidates_and_empty_tables(spark, tmp_path):
    rows = [(0, [0.5, 0.25]), (1, [1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(map(tuple, queries.QUERIES["op4_topk_search"](spark, folder_of(spark, tmp_path, df, "embeddings")).collect())) == [(0, 1, 1, 1024)]
    assert queries.QUERIES["op4_topk_search"](spark, folder_of(spark, tmp_path, df.limit(0), "embeddings")).count() == 0
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


# --- the registered queries on a given table


def test_registered_queries(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r) for r in queries.QUERIES["op5_substring_dedup"](spark, small).collect())
    assert got == Counter((i, n, gone, hashlib.sha256(t.encode()).hexdigest()) for i, n, gone, t in plain_repeats(rows))
    got = Counter(tuple(r) for r in queries.QUERIES["op6_simhash_near_dedup"](spark, small).collect())
    assert got == Counter(plain_components([(i, plain_simhash(t)) for i, t in rows]))


def test_near_dedup_stage_asks_fingerprints_and_deals_by_membership(spark, monkeypatch):
    """SimHash links are candidates of the stage, and a split bucket's member is dealt to as many parts as its level says."""
    plain_links, plain_dealt, asked, right = near_dedup.links, near_dedup._dealt, [], []
    monkeypatch.setattr(near_dedup, "links", lambda *a: (asked.append(a), plain_links(*a))[1])

    def dealt(members, sets, seed, bands, parts, shared):
        out = plain_dealt(members, sets, seed, bands, parts, shared)
        right.append(out.count() == parts * members.count())
        return out

    monkeypatch.setattr(near_dedup, "_dealt", dealt)
    df = spark.createDataFrame(families(8, 60), "doc_id long, text string").repartition(4)
    assert near_dedup.stage(spark, df, "").count() <= 8 and len(asked) == 1 and all(right)


def pairs_of_one_template(n, seed=9):
    """Pages of one template, two by two: mates reach 0.8, all others share buckets but stay apart."""
    rng = np.random.default_rng(seed)
    page, rows = [f"t{i}" for i in range(200)], []
    for k in range(n):
        words = list(page)
        for mate in range(2):
            for place in rng.choice(200, 3 if mate else 4, replace=False):
                words[place] = f"p{k}m{mate}x{place}"
            rows.append((len(rows), " ".join(words)))
    return rows


def test_near_dedup_stage_compares_what_levels_leave_apart(spark, monkeypatch):
    """No pair of a bucket with many groups is left out, however often it was dealt."""
    monkeypatch.setattr(near_dedup, "LEVELS", ())
    rows = pairs_of_one_template(300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = {i for (i, _), least in zip(rows, plain_similar(rows), strict=True) if i == least}
    assert {r.doc_id for r in near_dedup.stage(spark, df, "").collect()} == want and 250 < len(want) < 350
