"""Chat formatting by prefix-target expansion: every assistant turn becomes an example of its own.

An example is the conversation up to and with one assistant turn; only that reply is trainable. A turn is
written as ``<|im_start|>role``, a line feed, the text and ``<|im_end|>``, a line feed. Control strings inside roles and
texts get a backslash after their first character, one more if they have some already, so reading back is exact.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatlane.llm.common import column
from heatlane.operators.ordered import numbered
from heatlane.session import durable

START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
TARGET = "assistant"
#: Control strings, of this template and of other common ones, with any number of backslashes after the first character.
_CONTROL = re.compile(r"(<)(\\*)(/?s>|\|[A-Za-z0-9_]*\|>|</?SYS>>)|(\[)(\\*)(/?INST\])")
#: Turns of a conversation that one task expands; a longer conversation is dealt to several.
PART_TURNS = 512
#: Characters of an output batch.
_BATCH = 1 << 22


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[1] or m[4]}\\{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[1] or m[4]}{(m[2] or m[5] or '')[1:]}{m[3] or m[6]}", text)


def turn_text(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the text as written, and what stands after it."""
    return f"{START}{escape(role).replace('\n', LINE)}\n", escape(text), f"{END}\n"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of all turns of an example."""
    out = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        out.append((unescape(role.replace(LINE, "\n")), unescape(rest[: -len(END) - 1])))
    return out


def _parts(turns: DataFrame, part_turns: int) -> DataFrame:
    """``conv``, ``part``, ``place``, ``n``, ``role``, ``said``: turns in place (from 0) and their number. Turns of a long
    conversation are copied to every part that needs them, so that a part expands at most ``part_turns`` of them."""
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    long = durable(sizes.filter(F.col("n") > part_turns), "long")
    if long.isEmpty():
        return turns.withColumns({"part": F.lit(0).cast("long"), "parts": F.lit(1).cast("long")})
    heavy = turns.join(long, turns["conv"].eqNullSafe(long["conv"])).select(*[turns[c] for c in turns.columns], "n")
    calm = turns.join(long, turns["conv"].eqNullSafe(long["conv"]), "left_anti")
    # numbered() gives keys that are null no order, so the key is never null here
    keyed = heavy.withColumn("key", F.struct(F.col("conv").isNull().alias("none"), "conv"))
    order = ["last", "turn", "role", "said"]
    placed = numbered(keyed.withColumn("last", F.col("turn").isNull()), ["key"], order, "place", part_turns).drop("key", "last")
    part = F.floor((F.col("place") - 1) / part_turns)
    parts = F.ceil(F.col("n") / part_turns)
    copies = placed.select(*turns.columns, F.explode(F.sequence(part, parts - 1)).alias("part"), parts.alias("parts"))
    return calm.withColumns({"part": F.lit(0).cast("long"), "parts": F.lit(1).cast("long")}).unionByName(copies)


def expand(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", part_turns: int = PART_TURNS
) -> DataFrame:
    """``conv_id``, ``parts``, ``example`` (the place of its last turn), ``text``, ``loss_start``, ``loss_end``, ``last``.

    One row per assistant turn, in order of conversation and turn within a partition; the mask is a span of code points and covers the
    reply as written. Turns after the last reply have one more example, with an empty span, so
    every turn stands in an example; ``last`` marks the example with the whole conversation.

    Rows go by turn (null last), equal ones by role and text; repeated rows are turns of their own. A null role or
    text is the empty one, and a null id is a conversation like others. An empty reply has an empty span. Texts of any length
    are whole; a task holds the text of one conversation. ``parts`` is the number of tasks that a conversation was dealt to; part
    by part the examples are in order. An empty table has no example. Other columns are not read.
    """
    kind = conversations.select(column(id_col).alias("c")).schema["c"].dataType.simpleString()
    blank = F.lit("")
    turns = conversations.select(
        column(id_col).alias("conv"), column(turn_col).alias("turn"),
        F.coalesce(column(role_col).cast("string"), blank).alias("role"), F.coalesce(column(text_col).cast("string"), blank).alias("said"),
    )
    dealt = _parts(turns, part_turns).repartition("conv", "part")
    ordered = dealt.sortWithinPartitions("conv", "part", F.asc_nulls_last("turn"), "role", "said")
    names = ["conv_id", "part", "parts", "example", "text", "loss_start", "loss_end", "last"]

    def run(batches):
        made, size, conv_type = [], 0, None

        def out():
            kinds = [conv_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*made, strict=True), kinds, strict=True)], names)

        for conv_type, row in _examples(batches, part_turns):
            made.append(row)
            size += len(row[4])
            if size >= _BATCH:
                yield out()
                made, size = [], 0
        if made:
            yield out()

    schema = f"conv_id {kind}, part long, parts long, example long, text string, loss_start long, loss_end long, last boolean"
    return ordered.mapInArrow(run, schema)


def _examples(batches: Iterator[pa.RecordBatch], part_turns: int):
    """(type of the id, an example) over turns in order; the text so far is kept as pieces and joined per example."""
    key, text, place, pending, parts, kind = None, "", 0, False, 1, None

    def close(key, text, place, pending, parts):
        """The example of the turns after the last reply, if this part has the end of the conversation."""
        conv, part = key
        if pending and part == parts - 1:
            yield kind, (conv, part, parts, place - 1, text, len(text), len(text), True)

    held = None  # the last example of a conversation is known when its turns end
    for batch in batches:
        kind = batch.column("conv").type
        for conv, part, n, role, said in zip(*[batch.column(c).to_pylist() for c in ("conv", "part", "parts", "role", "said")], strict=True):
            if (conv, part) != key:
                if key is not None:
                    if held is not None:
                        yield kind, (*held, not pending and key[1] == parts - 1)
                    yield from close(key, text, place, pending, parts)
                key, text, place, pending, parts, held = (conv, part), "", 0, False, n, None
            before, written, after = turn_text(role, said)
            start = len(text) + len(before)
            text += before + written + after
            pending = role != TARGET
            if not pending and place // part_turns == part or not pending and n == 1:
                if held is not None:
                    yield kind, (*held, False)
                held = (conv, part, n, place, text, start, start + len(written))
            place += 1
    if key is not None:
        if held is not None:
            yield kind, (*held, not pending and key[1] == parts - 1)
        yield from close(key, text, place, pending, parts)


def read_back(examples: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``, read from
    the examples alone. Turns come from a conversation's last example; hashes grow example by example. Replies
    of a conversation in several parts are read from each, then hashed in order."""
    kind = examples.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "parts", "example", "n_turns", "turns_sha256", "loss_chars", "loss", "formatted_chars"]

    def run(batches):
        key, state = None, None
        for batch in batches:
            kinds = [batch.column("conv_id").type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            rows = []
            for conv, part, parts, example, text, a, b, last in zip(*map(batch.column, ("conv_id", "part", "parts", "example", "text", "loss_start", "loss_end", "last")), strict=True):
                conv, part, parts, text = conv.as_py(), part.as_py(), parts.as_py(), text.as_py()
                loss = unescape(text[a.as_py() : b.as_py()])
                if key != (conv, part):
                    key, state = (conv, part), [hashlib.sha256(), 0, 0]
                state[1] += len(loss)
                state[2] += len(text)
                state[0].update(loss.encode())
                n, digest = None, None
                if last.as_py():
                    turns = read_turns(text)
                    n, sha = len(turns), hashlib.sha256()
                    for role, said in turns:
                        sha.update(f"{role}\n{said}\n".encode())
                    digest = sha.hexdigest()
                if parts > 1:
                    rows.append((conv, parts, example.as_py(), n, digest, len(loss), loss, len(text)))
                elif n is not None:
                    rows.append((conv, parts, 0, n, digest, state[1], state[0].hexdigest(), state[2]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    schema = f"conv_id {kind}, parts long, example long, n_turns long, turns_sha256 string, loss_chars long, loss string, formatted_chars long"
    read = durable(examples.mapInArrow(run, schema), "read-back")
    digest = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    done = read.filter("parts = 1").withColumnRenamed("loss", "loss_sha256").select(*digest)
    several = read.filter("parts > 1").repartition("conv_id").sortWithinPartitions("conv_id", "example")

    def join(batches):
        key, state, kind, rows = None, None, None, []
        for batch in batches:
            kind = batch.column("conv_id").type
            for r in batch.select(names[:1] + names[3:]).to_pylist():
                if state is None or r["conv_id"] != key:
                    if state is not None:
                        rows.append((key, *state[:3], state[3].hexdigest(), state[4]))
                    key, state = r["conv_id"], [None, None, 0, hashlib.sha256(), 0]
                if r["n_turns"] is not None:
                    state[:2] = r["n_turns"], r["turns_sha256"]
                state[2] += r["loss_chars"]
                state[3].update(r["loss"].encode())
                state[4] += r["formatted_chars"]
        if state is not None:
            rows.append((key, *state[:3], state[3].hexdigest(), state[4]))
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], digest)

    joined = several.mapInArrow(join, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return done.unionByName(joined)
