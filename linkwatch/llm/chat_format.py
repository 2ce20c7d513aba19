"""Conversations rebuilt from event logs and rendered for training.

An event log has the columns conv_id, seq, kind, message, role and text:

``message``     a whole message; replaces what the message had before
``delta``       text appended to the message
``edit``        replaces the text of the message
``regenerate``  empties the message and drops the messages that came after it

Folding is done per message, never per conversation, so a very long
conversation is spread like any other rows.  A rendered turn is a row of its
own; the turns of a conversation in order are its formatted text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwatch.llm.common import landed

# Marks of the template; a blank stands between a mark and a text.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("[ANSWER]", "</s>"),
}
CONTROL = r"</?s>|<</?SYS>>|\[/?INST\]|\[ANSWER\]|\[ROLE:[^\]\s]*\]|\[/ROLE\]"
# a run of backslashes is tried from its start alone, so a long one takes linear time
_ESCAPE = re.compile(rf"(?<!\\)\\*(?:{CONTROL})")
_RESTORE = re.compile(rf"(?<!\\)\\(\\*(?:{CONTROL}))")
_FIRST = re.compile(rf"({CONTROL}) ")
TURNS = "conv_id long, seq long, body string, loss_start long, loss_end long"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long"
)


def escape(text: str) -> str:
    """One more backslash before every control string, so none is left bare."""
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def restore(text: str) -> str:
    return _RESTORE.sub(lambda m: m[1], text)


def marks(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (f"[ROLE:{quote(role, safe='')}]", "[/ROLE]")


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn's formatted text and the span of its text there, in code points."""
    begin, end = marks(role)
    head, body = begin + " ", escape(text)
    return f"{head}{body} {end}", len(head), len(head) + len(body)


def parse(turn: str) -> tuple[str, str]:
    """Role and text of a formatted turn: the inverse of :func:`render`."""
    start = _FIRST.match(turn)
    mark = start[1]
    role = next((r for r, (m, _) in MARKS.items() if m == mark), None)
    role = unquote(mark[len("[ROLE:") : -1]) if role is None else role
    return role, restore(turn[start.end() : -len(marks(role)[1]) - 1])


def folded(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, seq of the first event, role, text.

    Null texts are empty, a null role is taken from the message's other events
    and is empty if none has one.  Events of the same seq are taken in the order
    of kind and text.  Null ids form a conversation of their own.  A message
    that was only regenerated is empty.  An empty log has no messages.
    """
    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("seq").cast("long").alias("seq"),
        "kind",
        "message",
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    step = F.array_sort(F.collect_list(F.struct("seq", "kind", "text", "role")))
    whole = log.groupBy("conv_id", "message").agg(
        F.min("seq").alias("seq"), step.alias("steps")
    )
    text = F.aggregate(
        "steps",
        F.lit(""),
        lambda a, e: F.when(e["kind"] == "delta", F.concat(a, e["text"]))
        .when(e["kind"] == "regenerate", F.lit(""))
        .otherwise(e["text"]),
    )
    roles = F.transform("steps", lambda e: e["role"])
    # one event is the common case and needs no fold
    one = F.size("steps") == 1
    messages = whole.select(
        "conv_id",
        "seq",
        F.coalesce(
            F.when(one, F.col("steps")[0]["role"]).otherwise(
                F.get(F.filter(roles, lambda r: r.isNotNull()), F.lit(0))
            ),
            F.lit(""),
        ).alias("role"),
        F.when(one & (F.col("steps")[0]["kind"] != "regenerate"), F.col("steps")[0]["text"])
        .otherwise(text)
        .alias("text"),
    )
    cuts = log.where(F.col("kind") == "regenerate").groupBy("conv_id", "message")
    cuts = cuts.agg(F.max("seq").alias("until")).join(
        log.groupBy("conv_id", "message").agg(F.min("seq").alias("since")), ["conv_id", "message"]
    )
    cuts = cuts.select(F.col("conv_id").alias("cut_id"), "since", "until")
    dropped = (
        F.col("conv_id").eqNullSafe(F.col("cut_id"))
        & (F.col("seq") > F.col("since"))
        & (F.col("seq") < F.col("until"))
    )
    return messages.join(cuts, dropped, "left_anti")


def rendered(messages: DataFrame) -> DataFrame:
    """Formatted turns with the span of the text a loss applies to (else null).

    The span counts code points from the start of the turn; only assistants'
    texts are learned.
    """

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles = batch.column(2).to_pylist()
            out = [render(r, t) for r, t in zip(roles, batch.column(3).to_pylist(), strict=True)]
            learned = [r == "assistant" for r in roles]
            spans = [
                [x[k] if use else None for x, use in zip(out, learned, strict=True)] for k in (1, 2)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array([x[0] for x in out], pa.string()),
                    *[pa.array(x, pa.int64()) for x in spans],
                ],
                names=["conv_id", "seq", "body", "loss_start", "loss_end"],
            )

    return messages.select("conv_id", "seq", "role", "text").mapInArrow(show, TURNS)


def digests(turns: DataFrame) -> DataFrame:
    """What a reader of the formatted turns finds, per conversation.

    Turns stream through in order, one at a time, so a task holds no
    conversation; a digest of one text is sequential by nature.  Turns of the
    same seq are in the order of their formatted text.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in DIGESTS.split(", ")]
        kinds = [
            pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()
        ]
        state, key, done = None, None, []

        def finish() -> None:
            n, every, chars, learned, total = state
            done.append((key, n, every.hexdigest(), chars, learned.hexdigest(), total))

        def emit() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            for conv, body, start, end in zip(
                *[batch.column(i).to_pylist() for i in (0, 2, 3, 4)], strict=True
            ):
                if state is None or conv != key:
                    if state is not None:
                        finish()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(body)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[4] += len(body)
                if start is not None:
                    learned = restore(body[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
            yield emit()
        if state is not None:
            finish()
            yield emit()

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "body")
    return ordered.mapInArrow(read, DIGESTS)


def formatted(events: DataFrame) -> DataFrame:
    """The rendered turns of an event log, written to the shared folder."""
    return landed(rendered(folded(events)), "formatted-turns")
