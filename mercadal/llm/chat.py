"""Chat formatting by prefix-target expansion.

Each turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Every assistant turn is
an example of its own: all earlier turns are its context and only its reply is
trainable. A conversation's formatted text is stored once, in turns with their
offsets; an example is a range of it (from the start to the end of its target)
with the range of the loss in it, so a conversation of n turns does not turn
into n copies of itself. ``render`` writes out the texts of chosen examples.

Control strings inside roles and texts are escaped reversibly: a backslash is
doubled, and a control string gets a backslash behind its first sign, so none
is left whole.

Null roles and texts count as empty. Turns follow ``turn`` (nulls first), ties
role and text; repeated turns stay. Rows without ``conv_id`` form one
conversation. A conversation without an assistant turn has no example, but its
turns are stored. Extra columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercadal.llm.tables import stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
# strings that chat templates in use give a meaning
CONTROL = r"[<\[](?=/?s>|\|[A-Za-z_]+\||/?INST\]|<?/?SYS>>)"
TARGET = "assistant"
TURN = re.compile(re.escape(OPEN) + r"([^\n]*)\n(.*)" + re.escape(CLOSE), re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escaped(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({CONTROL})", r"$1\\")


def escaped_role(role: Column) -> Column:
    """A role stands on one line, so its line ends are escaped as well."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def unescaped_role(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def format_turns(turns: DataFrame) -> DataFrame:
    """Stored turns (conv_id, place, segment, first, n_chars, loss_first, loss_chars):
    ``segment`` begins at ``first`` in the conversation's text, its reply, if it
    is trainable, at ``loss_first``."""
    head = F.concat(F.lit(OPEN), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    rows = turns.select(
        "conv_id", "turn", "role", "text", F.length(head).alias("head"), F.length(body).alias("body"),
        F.concat(head, body, F.lit(CLOSE)).alias("segment"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "conv_id", F.row_number().over(order).alias("place"), "segment",
        F.coalesce(F.sum(F.length("segment")).over(past), F.lit(0)).alias("first"), "head", "body", "role",
    )
    target = F.col("role") == TARGET
    rows = rows.select(
        "conv_id", "place", "segment", "first", F.length("segment").cast("long").alias("n_chars"),
        F.when(target, F.col("first") + F.col("head")).alias("loss_first"),
        F.when(target, F.col("body").cast("long")).alias("loss_chars"),
    )
    return stored(rows, "chat")


def examples(formatted: DataFrame) -> DataFrame:
    """(conv_id, place, context_turns, length, loss_first, loss_chars): one row per
    assistant turn. The example is the first ``length`` signs of the
    conversation's text; the loss covers ``loss_chars`` signs from ``loss_first``."""
    return formatted.where("loss_first is not null").select(
        "conv_id", "place", (F.col("place") - 1).alias("context_turns"),
        (F.col("first") + F.col("n_chars")).alias("length"), "loss_first", "loss_chars",
    )


def render(formatted: DataFrame, chosen: DataFrame) -> DataFrame:
    """Whole texts (conv_id, place, text, loss_first, loss_chars) of chosen
    examples. The texts of all examples of a conversation grow with the square
    of its turns, so this is for batches about to be trained on."""
    c = chosen.select(F.col("conv_id").alias("c"), F.col("place").alias("p"), "loss_first", "loss_chars")
    parts = c.join(
        formatted.select("conv_id", "place", "segment"),
        F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("place") <= F.col("p")),
    )
    whole = parts.groupBy("conv_id", "p", "loss_first", "loss_chars").agg(
        F.array_sort(F.collect_list(F.struct("place", "segment"))).alias("s")
    )
    text = F.array_join(F.transform("s", lambda x: x["segment"]), "")
    return whole.select("conv_id", F.col("p").alias("place"), text.alias("text"), "loss_first", "loss_chars")


SUMMARY = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "n_examples long, example_chars long"
)


def read_back(formatted: DataFrame, shown: DataFrame) -> DataFrame:
    """What the stored text and the examples over it (``shown``) say about each
    conversation: its turns and, under the loss ranges of its examples, its
    replies, unescaped.

    An example comes right behind the last segment that it covers, so both
    stream by in order, and even a conversation of any length needs no more
    than its running digests. ``example_chars`` is the length of all examples
    written out. An example that does not end with its target turn, or whose
    loss is not inside that turn, fails.
    """

    def run(batches):
        now, state, last, rows = None, None, "", []

        def close():
            n, turns, chars, loss, size, shown, covered = state
            rows.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size, shown, covered))

        for batch in batches:
            for conv, segment, length, loss_first, loss_chars in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != now:
                    if state is not None:
                        close()
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                if segment is not None:
                    role, text = TURN.fullmatch(segment).groups()
                    state[0] += 1
                    state[1].update(f"{unescaped_role(role)}\n{unescaped(text)}\n".encode())
                    state[4] += len(segment)
                    last = segment
                    continue
                start = loss_first - (length - len(last))
                if length != state[4] or start < 0 or start + loss_chars > len(last):
                    raise ValueError(f"example of conversation {conv} does not end with its reply")
                reply = unescaped(last[start : start + loss_chars])
                state[2] += len(reply)
                state[3].update(reply.encode())
                state[5] += 1
                state[6] += length
            yield packed(rows)
            rows = []
        if state is not None:
            close()
            yield packed(rows)

    def packed(rows):
        got = list(zip(*rows, strict=True)) or [[]] * 8
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples", "example_chars"]
        return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(got, kinds, strict=True)], names=names)

    segments = formatted.select("conv_id", "place", "segment")
    both = segments.unionByName(shown.select("conv_id", "place", "length", "loss_first", "loss_chars"), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "place", F.col("segment").isNull())
    return ordered.select("conv_id", "segment", "length", "loss_first", "loss_chars").mapInArrow(run, SUMMARY)
