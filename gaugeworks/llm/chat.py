"""Chat formatting in budgeted windows.

Turns become text by a template whose control strings are escaped, reversibly,
wherever a text holds them.  Prefix sums of the turns' tokens lay a conversation
along a line; the line is cut every ``span`` tokens and a span of turns is what
lies between two cuts, a turn across a cut going with the span after it if that
fits, and alone if not.  Every window repeats the system turn and the last
turns before its span, up to a number of tokens; the loss mask covers assistant
texts of the span only, so nothing is a target twice.

Prefix sums, spans and history are joins and sums keyed by conversation and
place, so a conversation of any length is spread over the cluster.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref
from gaugeworks.llm.frames import Batches, batches_of, whole_text, with_running_totals
from gaugeworks.llm.tokens import worker_encoder
from gaugeworks.sources.scratch import written

#: Tokens of a window besides its system turn: new turns, and repeated ones before them.
SPAN_TOKENS = 1024
HISTORY_TOKENS = 256
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"

# The template's control strings: a turn's mark, the end of its role, the end of the turn.
MARK, AFTER_ROLE, END = "### ", ": ", " </turn>\n"
_ESCAPED_TEXT = re.compile(r"\\|#(?=##)|<(?=/turn>)")
_ESCAPED_ROLE = re.compile(r"[\\#<:]")
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|(?! </turn>\n)[^\\])*) </turn>\n", re.DOTALL)


def escaped(text: str) -> str:
    """The text with a backslash before every backslash and every beginning of a control string."""
    return _ESCAPED_TEXT.sub(lambda found: "\\" + found.group(), text)


def unescaped(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


def rendered(role: str, text: str) -> tuple[str, int, int]:
    """A turn as text, with begin and length of the escaped text inside it, in code points."""
    head = MARK + _ESCAPED_ROLE.sub(lambda found: "\\" + found.group(), role) + AFTER_ROLE
    inner = escaped(text)
    return head + inner + END, len(head), len(inner)


def parsed(formatted: str) -> list[tuple[str, str, int, int]]:
    """Role, text, begin and end of the escaped text, per turn of a formatted window."""
    found, at = [], 0
    for turn in _TURN.finditer(formatted):
        if turn.start() != at:
            raise ValueError("text between turns")
        found.append((unescaped(turn.group(1)), unescaped(turn.group(2)), *turn.span(2)))
        at = turn.end()
    if at != len(formatted):
        raise ValueError("text after the last turn")
    return found


def _turns(conversations: DataFrame, path: str, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text, row, tokens, system``: what a turn costs when rendered."""
    rows = conversations.select(
        ref(conv_col).alias("conv"),
        ref(turn_col).alias("turn"),
        whole_text(role_col).alias("role"),
        whole_text(text_col).alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())

    def counted(batches: Batches) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path, True)
        for batch in batches:
            pairs = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            tokens = [max(1, encoder.count(rendered(role, text)[0])) for role, text in pairs]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], [*batch.schema.names, "tokens"])

    return rows.mapInArrow(counted, T.StructType(list(rows.schema.fields)).add("tokens", "long"))


def budgeted_windows(
    conversations: DataFrame,
    path: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    span_tokens: int = SPAN_TOKENS,
    history_tokens: int = HISTORY_TOKENS,
) -> DataFrame:
    """``conv, window, formatted, repeated, loss, tokens``: the training windows of every conversation.

    ``formatted`` is the text; its first ``repeated`` turns are the system turn
    and history of earlier windows; ``loss`` are the begins and lengths, in code
    points, of the masked-in assistant texts; windows count up along the
    conversation but may leave out numbers.  Turns are ordered by ``turn_col``
    (null first), then by place in the input, so equal rows are turns of their
    own.  Null roles and texts are empty; null conversation ids are one
    conversation; a turn longer than the budget has a window of its own and is
    never cut; an empty table has no windows.  The system turn is the first turn
    if its role is ``system``.  Other columns are not looked at.
    """
    turns = _turns(conversations, path, conv_col, turn_col, role_col, text_col)
    counted = written(turns.withColumn("one", F.lit(1).cast("long")), "turns")
    order = ("conv", "turn", "row")
    # The system turn comes first and takes no room of the spans.
    placed = with_running_totals(counted, order, "one", "place", group="conv", label="turns")
    room = placed.withColumns(
        {
            "system": (F.col("place") == 0) & (F.col("role") == SYSTEM_ROLE),
            "room": F.when((F.col("place") == 0) & (F.col("role") == SYSTEM_ROLE), F.lit(0)).otherwise(F.col("tokens")).cast("long"),
        }
    )
    laid = written(
        with_running_totals(written(room, "room"), ("conv", "place"), "room", "begin", group="conv", label="laid").withColumn(
            "end", F.col("begin") + F.col("room")
        ),
        "laid",
    )
    first, last = F.floor(F.col("begin") / span_tokens), F.floor((F.col("end") - 1) / span_tokens)
    # Even spans lie between cuts, odd ones are the turn across a cut.
    cell = F.when(F.col("system") | (first == last), 2 * first).otherwise(2 * last - 1).cast("long")
    celled = laid.withColumn("cell", cell)
    cells = celled.groupBy("conv", "cell").agg(F.min("begin").alias("from"), F.max("end").alias("to"))
    across, after = cells.filter("cell % 2 != 0").alias("x"), cells.alias("y")
    fits = F.col("x.conv").eqNullSafe(F.col("y.conv")) & (F.col("y.cell") == F.col("x.cell") + 1)
    merged = across.join(after, fits).filter(F.col("y.to") - F.col("x.from") <= span_tokens).select(
        F.col("y.conv").alias("conv"), F.col("y.cell").alias("cell"), F.col("x.cell").alias("window")
    )
    new = (
        celled.alias("t")
        .join(merged.alias("m"), F.col("t.conv").eqNullSafe(F.col("m.conv")) & (F.col("t.cell") == F.col("m.cell")), "left")
        .select("t.*", F.coalesce("m.window", "t.cell").alias("window"))
    )
    new = written(new, "spans")
    starts = new.groupBy("conv", "window").agg(F.min("begin").alias("start"), F.max("system").alias("has_system"))
    shown = ["conv", "window", "place", "role", "text", "tokens"]

    # History: turns that begin at most so many tokens before the span, looked up by cells of that size.
    wide = max(1, history_tokens)
    wanted = starts.filter("start > 0").select(
        "conv", "window", "start", F.explode(F.array(F.floor((F.col("start") - 1) / wide), F.floor((F.col("start") - 1) / wide) - 1)).alias("near")
    )
    known = new.filter(~F.col("system")).withColumn("near", F.floor(F.col("begin") / wide)).drop("window")
    history = (
        known.alias("t")
        .join(wanted.alias("w"), F.col("t.conv").eqNullSafe(F.col("w.conv")) & (F.col("t.near") == F.col("w.near")))
        .filter("t.begin < w.start AND t.begin >= w.start - " + str(int(history_tokens)))
        .select("t.conv", "w.window", "t.place", "t.role", "t.text", "t.tokens", F.lit(True).alias("again"))
    )
    systems = (
        new.filter("system").drop("window").alias("t")
        .join(starts.filter("NOT has_system").alias("w"), F.col("t.conv").eqNullSafe(F.col("w.conv")))
        .select("t.conv", "w.window", "t.place", "t.role", "t.text", "t.tokens", F.lit(True).alias("again"))
    )
    rows = new.select(*shown, F.lit(False).alias("again")).unionByName(history).unionByName(systems)
    # A window holds a bounded number of tokens, so its turns may meet in one value.
    windows = rows.groupBy("conv", "window").agg(
        F.array_sort(F.collect_list(F.struct("place", "again", "role", "text"))).alias("turns"), F.sum("tokens").alias("tokens")
    )

    def formatted(batches: Batches) -> Batches:
        for batch in batches:
            schema = pa.schema(
                [
                    ("conv", batch.schema.field("conv").type),
                    ("window", pa.int64()),
                    ("formatted", pa.string()),
                    ("repeated", pa.int64()),
                    ("loss", pa.list_(pa.struct([("begin", pa.int64()), ("length", pa.int64())]))),
                    ("tokens", pa.int64()),
                ]
            )

            def out(batch=batch):
                for row in batch.to_pylist():
                    texts, loss, at = [], [], 0
                    for turn in row["turns"]:
                        text, begin, length = rendered(turn["role"], turn["text"])
                        if turn["role"] == TARGET_ROLE and not turn["again"]:
                            loss.append({"begin": at + begin, "length": length})
                        texts.append(text)
                        at += len(text)
                    repeated = sum(turn["again"] for turn in row["turns"])
                    yield row["conv"], row["window"], "".join(texts), repeated, loss, row["tokens"]

            yield from batches_of(schema, out())

    kind = counted.schema["conv"].dataType.simpleString()
    return windows.mapInArrow(
        formatted,
        f"conv {kind}, window long, formatted string, repeated long, loss array<struct<begin:bigint,length:bigint>>, tokens long",
    )


def read_back(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the windows say: ``conv_col, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows``.

    The windows of a conversation stream through one task in order, as a digest
    of the whole conversation asks for; only the digests' state is held.
    """
    kind = windows.schema["conv"].dataType.simpleString()
    ordered = windows.repartition("conv").sortWithinPartitions("conv", "window")

    def read(batches: Batches) -> Batches:
        def out():
            current = None
            for batch in batches:
                for row in batch.to_pylist():
                    if current is None or current[0] != row["conv"]:
                        if current is not None:
                            yield result(current)
                        current = [row["conv"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    text = row["formatted"]
                    for role, said, _, _ in parsed(text)[row["repeated"] :]:
                        current[1] += 1
                        current[2].update(f"{role}\n{said}\n".encode())
                    for span in row["loss"]:
                        target = unescaped(text[span["begin"] : span["begin"] + span["length"]])
                        current[3] += len(target)
                        current[4].update(target.encode())
                    current[5] += len(text)
                    current[6] += 1
            if current is not None:
                yield result(current)

        def result(found):
            return found[0], found[1], found[2].hexdigest(), found[3], found[4].hexdigest(), found[5], found[6]

        yield from batches_of(schema, out())

    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    conv = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    schema = pa.schema([("conv", conv), *zip(names, types)])
    ddl = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types))
    return ordered.mapInArrow(read, f"conv {kind}, {ddl}").withColumnRenamed("conv", conv_col)
