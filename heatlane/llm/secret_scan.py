"""Secret scans: a trigram index chooses which documents a rule has to read."""

from __future__ import annotations

import itertools
import re._constants as sre
import re._parser as parser
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import column, text_of, whole_row

#: At most so many spellings of a literal stretch are followed before it is ended.
MAX_SPELLINGS = 64


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """A kind of secret: pattern, and the group that must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @cached_property
    def query(self) -> list[list[frozenset[str]]]:
        return trigram_query(self.pattern)


_NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: The base rules. A run of hex digits is maximal either way, so its least length can stand in the pattern.
BASE = (
    Rule("assign", f"""({_NAMES})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]{16,}", 0, 16),
)
#: Public formats of further credentials.
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", "[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z]{2,12}://[A-Za-z0-9._-]+:[A-Za-z0-9._~%!*+-]+@[A-Za-z0-9.-]+"),
)
RULES = BASE + MORE


def _spellings(node) -> list[str] | None:
    """The few lower-cased strings a node can match, or None if they are many."""
    op, arg = node
    if op is sre.LITERAL:
        return [chr(arg).lower()]
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
        return sorted({chr(c).lower() for _, c in arg})
    if op is sre.SUBPATTERN:
        return _joined(arg[3])
    if op is sre.BRANCH:
        parts = [_joined(p) for p in arg[1]]
        return None if None in parts else sorted(set(itertools.chain(*parts)))
    if op is sre.MAX_REPEAT and arg[1] <= 1:
        inner = _joined(arg[2])
        return inner if inner is None or arg[0] == 1 else sorted({"", *inner})
    return None


def _joined(nodes) -> list[str] | None:
    out = [""]
    for node in nodes:
        here = _spellings(node)
        if here is None or len(out) * len(here) > MAX_SPELLINGS:
            return None
        out = [a + b for a in out for b in here]
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """A condition every text with a match meets, on its lower-cased trigrams:
    all of the clauses, of each clause one option, of an option all trigrams.
    Empty if the pattern has no mandatory trigram."""
    stretches, run = [], [""]
    for node in [*parser.parse(pattern), None]:
        here = None if node is None else _spellings(node)
        if here is not None and len(run) * len(here) <= MAX_SPELLINGS:
            run = [a + b for a in run for b in here]
            continue
        stretches.append(run)
        run = here if here is not None and len(here) <= MAX_SPELLINGS else [""]
        if node is not None and node[0] is sre.MAX_REPEAT and node[1][0] >= 1 and here is None:
            inner = _joined(node[1][2])
            stretches.append(inner or [""])
    stretches.append(run)
    clauses = []
    for run in stretches:
        options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in options:
            clauses.append(sorted((o for o in options if not any(p < o for p in options)), key=sorted))
    return clauses


def postings(docs: DataFrame, id_col: str, text_col: str, rules=RULES) -> DataFrame:
    """The inverted index, limited to trigrams that a rule asks for: one row
    (trigram, key) for each document that has the trigram in any case. ``key``
    is a hash of id and text; two documents of one key share their postings,
    which can only add candidates."""
    wanted = sorted({t for r in rules for clause in r.query for option in clause for t in option})
    text = text_of(text_col)
    folded = docs.select(F.xxhash64(column(id_col), text).alias("key"), F.lower(text).alias("folded"))
    present = F.array_compact(F.array(*[F.when(F.contains(F.col("folded"), F.lit(t)), F.lit(t)) for t in wanted]))
    return folded.select("key", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """Intersects the postings: (key, kinds whose trigram query the document meets).

    The table of terms is as large as the rule list, so it is sent to all tasks.
    One shuffle by key serves every grouping that follows.
    """
    terms = [
        (t, r.kind, c, o, len(option), len(r.query))
        for r in rules for c, clause in enumerate(r.query) for o, option in enumerate(clause) for t in sorted(option)
    ]
    table = index.sparkSession.createDataFrame(terms, "trigram string, kind string, clause int, opt int, need int, clauses int")
    met = (
        index.repartition("key").distinct().join(F.broadcast(table), "trigram")
        .groupBy("key", "kind", "clause", "opt", "need", "clauses").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == F.col("need"))
        .groupBy("key", "kind", "clauses").agg(F.count_distinct("clause").alias("n"))
        .filter(F.col("n") == F.col("clauses"))
    )
    return met.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


_CHUNK = 256


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Leftmost matches that don't overlap, as (start, order, end), from the
    lengths of the matches and of the text between them. Finished chunks are set
    aside, so that a text with very many matches isn't copied for each."""
    pattern = F.lit(rule.pattern)
    found = lambda group: F.regexp_extract_all(text, pattern, F.lit(group))
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"), found(0).alias("match"), found(rule.group).alias("value")
    )
    kind = "struct<start:int,kind:int,stop:int>"
    zero = F.struct(
        F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("cur"), F.array().cast(f"array<array<{kind}>>").alias("done")
    )

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), stop.alias("stop"))
        cur = F.when(F.length(x["value"]) >= rule.least, F.array_append(acc["cur"], span)).otherwise(acc["cur"])
        full = F.size(acc["cur"]) >= _CHUNK
        empty = F.array().cast(f"array<{kind}>")
        kept = F.when(F.length(x["value"]) >= rule.least, F.array(span)).otherwise(empty)
        return F.struct(
            stop.alias("at"), F.when(full, kept).otherwise(cur).alias("cur"),
            F.when(full, F.array_append(acc["done"], acc["cur"])).otherwise(acc["done"]).alias("done"),
        )

    return F.aggregate(parts, zero, step, lambda a: F.flatten(F.array_append(a["done"], a["cur"])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Columns ``row`` (all columns but the text) and ``spans``, an array of
    (start, kind, stop) in code points, end exclusive, ordered by start and then
    by place of the kind in ``rules``; one row per input row.

    A document is read by a rule only if the intersection of postings names it;
    rules without a mandatory trigram read all documents. Null or empty text has
    no spans. Ids may be null or repeat. An empty table gives an empty result.
    """
    text = text_of(text_col)
    whole = docs.select(
        F.xxhash64(column(id_col), text).alias("key"), whole_row(docs, text_col), text.alias("text")
    )
    named = whole.join(candidates(postings(docs, id_col, text_col, rules), rules), "key", "left")
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")
    parts = []
    for order, rule in enumerate(rules):
        asked = F.array_contains("kinds", rule.kind) if rule.query else F.lit(True)
        parts.append(F.when(asked & F.col("text").rlike(rule.pattern), _spans(F.col("text"), rule, order)).otherwise(none))
    return named.select("row", F.sort_array(F.concat(*parts)).alias("spans"))


def span_text(spans: Column, rules=RULES) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["stop"])), ",")
