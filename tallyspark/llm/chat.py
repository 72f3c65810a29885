"""Conversations as training windows of a token budget.

Every turn is rendered as ``<|im_start|>role``, a line break, its text and ``<|im_end|>``.
Texts and roles are escaped so that no control string of common templates can occur in
them; the escape is undone exactly by ``unescape``.  Prefix sums of the turns' tokens
choose the windows: a window holds the turns whose first token falls into one stretch of
``target`` tokens, where ``target`` is half of what the budget leaves beside the system
turn and the history, and a turn longer than ``target`` has a window of its own.  So no
window exceeds the budget but for a single turn (or a system turn) that does so alone; it
is kept whole and flagged ``over_budget``.  Each window repeats the system turn and the
turns before it that fit into ``history`` tokens.  The loss mask covers the text of every
assistant turn where it stands first, and never a repeated one.

A conversation that holds a third of all rows is summed in blocks of turns, so prefix
sums need no task that sees all of it.

Defined results: null text or role is empty; a null conv_id is a conversation; turns with
the same or no number are ordered by turn (nulls first), role, text; repeated rows are
turns of their own; only a first turn of role ``system`` is the system turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspark.llm import bpe
from tallyspark.session import materialized

START, END = "<|im_start|>", "<|im_end|>\n"
# Order matters: the escape sign itself goes first, and comes back last.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;")]
LINE_BREAK = ("\n", "&#10;")
BUDGET = 1024
HISTORY = 160
BLOCK = 64


def escape(col: Column) -> Column:
    for plain, coded in ESCAPES:
        col = F.replace(col, F.lit(plain), F.lit(coded))
    return col


def unescape(text: str) -> str:
    for plain, coded in reversed(ESCAPES):
        text = text.replace(coded, plain)
    return text


def unescape_role(text: str) -> str:
    return unescape(text.replace(LINE_BREAK[1], LINE_BREAK[0]))


def read_turns(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a formatted text."""
    found = re.findall(r"<\|im_start\|>([^\n]*)\n([^<]*)<\|im_end\|>\n", text)
    if sum(len(START) + len(r) + 1 + len(t) + len(END) for r, t in found) != len(text):
        raise ValueError("not a formatted text")
    return [(unescape_role(role), unescape(body)) for role, body in found]


def _numbered(turns: DataFrame, path: str | None) -> DataFrame:
    """Rendered turns with their place and first token in the conversation."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("raw"),
        F.concat(F.lit(START), F.replace(escape(role), F.lit(LINE_BREAK[0]), F.lit(LINE_BREAK[1])), F.lit("\n")).alias("head"),
        escape(text).alias("body"),
    ).withColumns(
        {
            "n": bpe.n_tokens(F.concat("head", "body", F.lit(END)), path),
            "block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).cast("long"),
        }
    )
    rows = materialized(rows, "chat-turns")
    blocks = rows.groupBy("conv", "block").agg(F.count("*").alias("rows_in"), F.sum("n").alias("tokens_in"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv",
        "block",
        F.coalesce(F.sum("rows_in").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("tokens_in").over(before), F.lit(0)).alias("tokens_before"),
    )
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "raw")
    summed = rows.withColumns(
        {"row": F.row_number().over(inside), "end": F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))}
    )
    return summed.join(blocks, ["conv", "block"]).select(
        "conv",
        (F.col("rows_before") + F.col("row") - 1).alias("place"),
        (F.col("tokens_before") + F.col("end") - F.col("n")).alias("start"),
        "n",
        "role",
        "head",
        "body",
    )


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, path: str | None = None) -> DataFrame:
    """The windows of all conversations.

    Columns: ``conv_id``, ``window`` (rising along the conversation), ``text``, ``loss`` (spans of
    code points under the mask), ``n_repeated`` (leading turns that an earlier window holds too),
    ``n_tokens`` and ``over_budget``.
    """
    numbered = materialized(_numbered(turns, path), "chat-numbered")
    is_system = (F.col("place") == 0) & (F.col("role") == "system")
    system = numbered.filter(is_system).select(
        F.col("conv").alias("system_conv"), F.col("head").alias("system_head"), F.col("body").alias("system_body"), F.col("n").alias("system_n")
    )
    system_n = F.coalesce("system_n", F.lit(0))
    target = F.greatest(F.lit(1), F.floor((budget - history - system_n) / 2)).cast("long")
    body = (
        numbered.filter(~is_system)
        .join(system.select("system_conv", "system_n"), F.col("conv") == F.col("system_conv"), "left")
        .withColumns({"target": target, "at": F.col("start") - system_n})
        .withColumn("window", 2 * F.floor(F.col("at") / F.col("target")) + (F.col("n") > F.col("target")).cast("long"))
        .select("conv", "place", "at", "n", "role", "head", "body", "target", "window")
    )
    body = materialized(body, "chat-body")
    starts = body.groupBy("conv", "window").agg(F.min("at").alias("first"))
    # A short turn may be history of the few windows that begin within ``history`` tokens after it.
    stretch = F.floor(F.col("at") / F.col("target"))
    last = F.floor((F.col("at") + history) / F.col("target"))
    candidates = (
        body.filter(F.col("n") <= history)
        .withColumn("later", F.explode(F.sequence(2 * stretch, 2 * last + 1)))
        .select("conv", "place", "at", "n", "role", "head", "body", F.col("later").alias("window"))
    )
    repeated = candidates.join(starts, ["conv", "window"]).filter(
        (F.col("at") < F.col("first")) & (F.col("first") <= F.col("at") + history)
    )
    first_window = starts.groupBy(F.col("conv").alias("first_conv")).agg(F.min("window").alias("first_window"))
    systems = system.join(first_window, F.col("system_conv") == F.col("first_conv"), "left").select(
        "system_conv", "system_head", "system_body", "system_n", F.coalesce("first_window", F.lit(0)).alias("first_window")
    )
    columns = ["conv", "window", "place", "n", "head", "body"]
    repeats = starts.join(systems, (F.col("conv") == F.col("system_conv")) & (F.col("window") > F.col("first_window")))
    none = F.lit(False)
    parts = [
        body.select(*columns, none.alias("repeated"), (F.col("role") == "assistant").alias("counts")),
        repeated.select(*columns, F.lit(True).alias("repeated"), none.alias("counts")),
        systems.select(
            F.col("system_conv").alias("conv"), F.col("first_window").alias("window"), F.lit(0).alias("place"), F.col("system_n").alias("n"),
            F.col("system_head").alias("head"), F.col("system_body").alias("body"), none.alias("repeated"), none.alias("counts"),
        ),
        repeats.select(
            "conv", "window", F.lit(0).alias("place"), F.col("system_n").alias("n"), F.col("system_head").alias("head"),
            F.col("system_body").alias("body"), F.lit(True).alias("repeated"), none.alias("counts"),
        ),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    grouped = rows.groupBy("conv", "window").agg(
        F.sort_array(F.collect_list(F.struct("place", "head", "body", "repeated", "counts"))).alias("turns"),
        F.sum("n").alias("n_tokens"),
        F.sum(F.col("repeated").cast("int")).alias("n_repeated"),
    )
    kind = "array<struct<start:int,end:int>>"
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def place(done: Column, turn: Column) -> Column:
        start = done["at"] + F.length(turn["head"])
        end = start + F.length(turn["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(kind)
        return F.struct((end + len(END)).alias("at"), F.when(turn["counts"], F.concat(done["spans"], span)).otherwise(done["spans"]).alias("spans"))

    return grouped.select(
        F.when(F.col("conv") != "null", F.col("conv").cast("long")).alias("conv_id"),
        "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        F.aggregate("turns", empty, place)["spans"].alias("loss"),
        "n_repeated",
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted windows of each conversation say, read back from their texts and masks.

    The windows of a conversation meet in order in one task, which keeps running digests only.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_id, state = None, None

        def closed() -> list:
            n, turns, chars, loss, formatted = state
            return [open_id, n, turns.hexdigest(), chars, loss.hexdigest(), formatted]

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            rows = []
            for conv_id, text, loss, repeated in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv_id != open_id:
                    if state is not None:
                        rows.append(closed())
                    open_id, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = read_turns(text)
                for role, body in turns[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if rows:
                yield batch_of(rows)
        if state is not None:
            yield batch_of([closed()])

    ordered = (
        formatted.select("conv_id", "window", "text", "loss", "n_repeated")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "window")
        .drop("window")
    )
    return ordered.mapInArrow(run, schema)
