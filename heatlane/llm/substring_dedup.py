"""Substring dedup with automata of repeated phrases.

A window is 50 consecutive words. Equal windows share their anchor, the phrase of
16 words whose hash is the least in the window, so only windows around anchors
that recur in two documents can repeat. Windows of one anchor lie side by side
and form a run. Runs, not windows, are shuffled until it is known where
documents differ.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import column, text_of
from heatlane.session import durable

WINDOW, PHRASE = 50, 16
#: Documents of one automaton: patterns of so many are compiled together.
SHARD_DOCS = 256
#: Words that are hashed and searched for anchors at once; longer documents are taken alone.
BATCH_WORDS = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (the finaliser of a public generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


class Spans:
    """Hashes of any stretch of words, from a prefix sum."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        power = np.cumprod(np.full(n, _STEP, dtype=np.uint64)) if n else np.zeros(0, np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * power, dtype=np.uint64)])
        self.back = np.cumprod(np.full(n + 1, _BACK, dtype=np.uint64))

    def hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        length = (stop - start).astype(np.uint64)
        return _mix((self.sums[stop] - self.sums[start]) * self.back[start] + length)


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width``, the place of its least value, the last of equal ones."""
    least, place, size = values, np.arange(len(values)), 1
    while size < width:
        step = min(size, width - size)
        a, b = least[:-step], least[step:]
        later = b <= a
        least, place = np.where(later, b, a), np.where(later, place[step:], place[:-step])
        size += step
    return place


def _runs(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs over concatenated documents that end at ``ends``: document, anchor
    hash, hash of all words of the run with the anchor's place, start, number of windows."""
    none = np.zeros(0, np.int64)
    if len(hashes) < WINDOW:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    spans = Spans(hashes)
    at = np.arange(len(hashes) - PHRASE + 1)
    phrases = spans.hash(at, at + PHRASE)
    owner = _least_places(phrases, WINDOW - PHRASE + 1)
    start = np.arange(len(owner))
    doc = np.searchsorted(ends, start, side="right")
    inside = start + WINDOW <= ends[doc]
    start, owner, doc = start[inside], owner[inside], doc[inside]
    if not len(start):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    new = np.ones(len(start), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    start, owner, doc = start[first], owner[first], doc[first]
    body = spans.hash(start, start + count + WINDOW - 1)
    body = _mix(body ^ (owner - start).astype(np.uint64))
    return doc, phrases[owner], body, start - np.concatenate([[0], ends])[doc], count


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _find_runs(batches):
    for batch in batches:
        keys, docs, texts = batch.column(0), batch.column(1), batch.column(2)

        def made(words, rows):
            sizes = np.array([len(w) for w in words], dtype=np.int64)
            hashes = _word_hashes([x for w in words for x in w])
            doc, p, body, start, n = _runs(hashes, np.cumsum(sizes))
            take = pa.array(np.asarray(rows, dtype=np.int64)[doc])
            return pa.RecordBatch.from_arrays(
                [keys.take(take), docs.take(take), _long(p), _long(body), _long(start), _long(n)], ["key", "doc", "p", "body", "start", "n"]
            )

        held, rows, total = [], [], 0
        for i, text in enumerate(texts):
            words = text.as_py().encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
            if len(words) < WINDOW:
                continue
            held.append(words)
            rows.append(i)
            total += len(words)
            if total >= BATCH_WORDS:
                yield made(held, rows)
                held, rows, total = [], [], 0
        if held:
            yield made(held, rows)


def _windows(batches):
    """Hashes of all windows of a passage."""
    for batch in batches:
        p, body, lo, hi = (batch.column(c) for c in ("p", "body", "lo", "hi"))
        rows, idx, hashes = [], [], []
        for i, words in enumerate(batch.column("words")):
            spans = Spans(_word_hashes(words.as_py().encode("utf-8", "surrogatepass").split(b" ")))
            at = np.arange(len(spans.sums) - WINDOW)
            rows.append(np.full(len(at), i))
            idx.append(at)
            hashes.append(spans.hash(at, at + WINDOW))
        take = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
        flat = lambda x, kind: _long(np.concatenate(x)) if x else pa.array([], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [p.take(take), body.take(take), flat(idx, 0), flat(hashes, 0), lo.take(take), hi.take(take)],
            ["p", "body", "idx", "w", "lo", "hi"],
        )


def _confirmed(batches):
    """Cuts a passage into its recurring phrases: neighbouring windows first seen in the same document."""
    for batch in batches:
        out = defaultdict(list)
        for row in batch.to_pylist():
            words = row["words"].split(" ")
            seen = sorted((x["idx"], x["first"]) for x in row["found"])
            at = 0
            while at < len(seen):
                stop = at + 1
                while stop < len(seen) and seen[stop] == (seen[stop - 1][0] + 1, seen[at][1]):
                    stop += 1
                out["p"].append(row["p"])
                out["body"].append(row["body"])
                out["phrase"].append(" ".join(words[seen[at][0] : seen[stop - 1][0] + WINDOW]))
                out["first"].append(seen[at][1])
                at = stop
        yield pa.RecordBatch.from_pydict(
            {c: pa.array(out[c], pa.string() if c == "phrase" else pa.int64()) for c in ("p", "body", "phrase", "first")}
        )


class Automaton:
    """Finds phrases, given as words joined by blanks, in lists of words. Words
    are numbered, so matching is on words and exact; words of no phrase are 0."""

    def __init__(self, phrases):
        self.numbers: dict[str, int] = {}
        self.trie = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for phrase, first in phrases:
            key = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in phrase.split(" "))
            known = self.trie.get(key, None)
            if known is None or first < known[1]:
                self.trie.add_word(key, (len(key), first))
        if len(self.trie):
            self.trie.make_automaton()

    def covered(self, words: list[str], doc: int) -> np.ndarray:
        """Which words lie in an occurrence of a phrase that starts in a smaller document."""
        change = np.zeros(len(words) + 1, dtype=np.int64)
        if len(self.trie) and words:
            numbers = self.numbers
            for end, (length, first) in self.trie.iter(tuple(numbers.get(w, 0) for w in words)):
                if first < doc:
                    change[end + 1 - length] += 1
                    change[end + 1] -= 1
        return np.cumsum(change[:-1]) > 0


def _kept(words: list[str], gone: np.ndarray, digest: bool) -> str:
    text = " ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g) if gone.any() else " ".join(words)
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if digest else text


def _split(text: str) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``, the words left joined by
    one blank (or, with ``digest``, the SHA-256 of it); one row per input row.

    A word goes if it lies in a 50-word window whose words also start in a
    document of a smaller id. Words lie between ASCII white space. Ids are
    integers; rows of one id don't remove from each other. A row with a null id
    neither loses words nor takes any. Null, empty and short texts lose nothing.
    An empty table gives an empty result.
    """
    text = text_of(text_col)
    given = docs.select(
        F.xxhash64(column(id_col), text).alias("key"), column(id_col).cast("long").alias("doc"), text.alias("text")
    )
    runs = durable(given.mapInArrow(_find_runs, "key long, doc long, p long, body long, start long, n long"), "runs")

    # Anchors that recur; uniform if all their runs hold the same words.
    anchors = runs.groupBy("p").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), (F.min("body") == F.max("body")).alias("uniform"))
    recurring = durable(anchors.filter(F.col("a") < F.col("b")).select("p", "uniform"), "anchors")
    repeated = durable(runs.join(recurring, "p"), "repeated")
    passages = repeated.groupBy("p", "body").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
    tagged = repeated.join(durable(passages, "passages"), ["p", "body"])
    of_doc = tagged.groupBy(F.col("key").alias("k")).agg(F.collect_set(F.struct("start", "n", "p", "body", "lo", "hi", "uniform")).alias("runs"))

    # All texts move once; what follows needs those with recurring anchors only.
    def first_look(batches):
        for batch in batches:
            out = defaultdict(list)
            for doc, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "runs")), strict=True):
                words = _split(text)
                out["doc"].append(doc)
                out["n_words"].append(len(words))
                out["runs"].append(runs)
                out["kept"].append(None if runs else _kept(words, np.zeros(len(words), dtype=bool), digest))
                out["text"].append(text if runs else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc"], pa.int64()), pa.array(out["n_words"], pa.int64()), pa.array(out["kept"], pa.string()),
                 pa.array(out["text"], pa.string()), pa.array(out["runs"], batch.schema.field("runs").type), batch.column("key")],
                ["doc", "n_words", "kept", "text", "runs", "key"],
            )

    kind = "array<struct<start:long,n:long,p:long,body:long,lo:long,hi:long,uniform:boolean>>"
    looked = durable(
        given.join(of_doc, given["key"] == of_doc["k"], "left").select("key", "doc", "text", F.col("runs").cast(kind).alias("runs"))
        .mapInArrow(first_look, f"doc long, n_words long, kept string, text string, runs {kind}, key long"), "looked",
    )
    marked = looked.filter(F.col("runs").isNotNull())

    # Passages out of their first documents, and which of their windows recur.
    def cut(batches):
        for batch in batches:
            out = defaultdict(list)
            for doc, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "runs")), strict=True):
                mine = [r for r in runs if r["lo"] == doc and (r["lo"] < r["hi"] or not r["uniform"])]
                words = _split(text) if mine else []
                for r in mine:
                    out["words"].append(" ".join(words[r["start"] : r["start"] + r["n"] + WINDOW - 1]))
                    for c in ("p", "body", "lo", "hi", "uniform"):
                        out[c].append(r[c])
            types = {"p": pa.int64(), "body": pa.int64(), "lo": pa.int64(), "hi": pa.int64(), "uniform": pa.bool_(), "words": pa.string()}
            yield pa.RecordBatch.from_pydict({c: pa.array(out[c], t) for c, t in types.items()})

    schema = "p long, body long, lo long, hi long, uniform boolean, words string"
    passages = durable(marked.select("doc", "text", "runs").mapInArrow(cut, schema).distinct(), "passage_words")
    windows = passages.filter(~F.col("uniform")).select("p", "body", "lo", "hi", "words")
    windows = durable(windows.mapInArrow(_windows, "p long, body long, idx long, w long, lo long, hi long"), "windows")
    firsts = windows.groupBy("p", "w").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).filter(F.col("first") < F.col("last"))
    found = windows.join(durable(firsts, "firsts"), ["p", "w"]).filter(F.col("first") < F.col("hi"))
    found = found.groupBy("p", "body").agg(F.collect_list(F.struct("idx", "first")).alias("found"))
    whole = F.transform(
        F.sequence(F.lit(0).cast("long"), F.size(F.split("words", " ")).cast("long") - WINDOW),
        lambda i: F.struct(i.alias("idx"), F.col("lo").alias("first")),
    )
    phrases = passages.filter(F.col("uniform")).select("p", "body", "words", whole.alias("found")).unionByName(
        passages.filter(~F.col("uniform")).join(found, ["p", "body"]).select("p", "body", "words", "found")
    )
    phrases = durable(phrases.mapInArrow(_confirmed, "p long, body long, phrase string, first long"), "phrases")

    # Phrases go to the documents that hold their anchors, and automata find them there.
    asked = marked.select("key", "doc", F.explode("runs").alias("r")).select("key", "doc", "r.p", "r.body")
    wanted = asked.join(phrases, ["p", "body"]).filter(F.col("first") < F.col("doc"))
    wanted = wanted.groupBy(F.col("key").alias("k")).agg(F.collect_set(F.struct("phrase", "first")).alias("phrases"))

    def search(batches):
        for batch in batches:
            out = defaultdict(list)
            for at in range(0, batch.num_rows, SHARD_DOCS):
                rows = batch.slice(at, SHARD_DOCS).to_pylist()
                shard = Automaton({(x["phrase"], x["first"]) for r in rows for x in r["phrases"] or ()})
                for r in rows:
                    words = _split(r["text"])
                    gone = shard.covered(words, r["doc"]) if r["phrases"] else np.zeros(len(words), dtype=bool)
                    out["doc"].append(r["doc"])
                    out["n_words"].append(r["n_words"])
                    out["n_removed"].append(int(gone.sum()))
                    out["kept"].append(_kept(words, gone, digest))
            yield pa.RecordBatch.from_pydict(
                {c: pa.array(out[c], pa.string() if c == "kept" else pa.int64()) for c in ("doc", "n_words", "n_removed", "kept")}
            )

    searched = (
        marked.join(wanted, marked["key"] == wanted["k"], "left").select("doc", "n_words", "text", "phrases")
        .mapInArrow(search, "doc long, n_words long, n_removed long, kept string")
    )
    rest = looked.filter(F.col("runs").isNull()).select("doc", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept")
    return rest.unionByName(searched).withColumnRenamed("doc", "doc_id")
