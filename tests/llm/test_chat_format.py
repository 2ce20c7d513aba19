"""Folding against a plain replay, and the template's round trip."""

from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwatch.llm.chat_format import digests, folded, formatted, parse, render

PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ANSWER]", "[ROLE:x]",
          "[/ROLE]", "\\", "\\\\", " ", "\n", "a", "<", "[", "é", "S>>", "T]"]
EVENTS = "conv_id long, seq long, kind string, message string, role string, text string"


@settings(max_examples=800, deadline=None)
@given(
    st.sampled_from(["user", "assistant", "system", "tool", "", "odd ] role", "x:y"]),
    st.lists(st.sampled_from(PIECES), max_size=12).map("".join),
)
def test_round_trip(role, text):
    turn, start, end = render(role, text)
    assert parse(turn) == (role, text)
    assert 0 < start <= end < len(turn)


def replay(events):
    """Messages of each conversation after all its events, one by one in order."""
    out = {}
    for conv in {e[0] for e in events}:
        own = sorted((e for e in events if e[0] == conv), key=lambda e: (e[1], e[2], e[5] or ""))
        messages, first = {}, {}
        for _, seq, kind, message, role, text in own:
            first.setdefault(message, seq)
            m = messages.setdefault(message, ["", ""])
            m[0] = m[0] or role or ""
            if kind == "delta":
                m[1] += text or ""
            elif kind == "regenerate":
                m[1] = ""
                later = [x for x in messages if first[message] < first[x] < seq]
                for x in later:
                    messages[x] = None
                    del messages[x]
            else:
                m[1] = text or ""
        out[conv] = sorted((first[x], *m) for x, m in messages.items())
    return out


def random_log(rng):
    events = []
    for conv in range(40):
        live, seq = [], 0
        for n in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool"])
            name = f"m{n}"
            live.append(name)
            if rng.random() < 0.5:
                events.append((conv, seq, "message", name, role, rng.choice(["hi", None, "</s>"])))
                seq += 1
            for _ in range(rng.randrange(1, 4)):
                events.append((conv, seq, "delta", name, role, rng.choice(["a", "b ", "[INST]"])))
                seq += 1
            if rng.random() < 0.2:
                events.append((conv, seq, "edit", rng.choice(live), None, "edited"))
                seq += 1
            if rng.random() < 0.2:
                back = rng.randrange(len(live))
                events.append((conv, seq, "regenerate", live[back], None, None))
                live = live[: back + 1]
                seq += 1
                events.append((conv, seq, "delta", live[back], None, "again"))
                seq += 1
    return events


def test_folding_equals_a_replay(spark, rng):
    log = random_log(rng)
    rows = spark.createDataFrame(log, EVENTS).repartition(5).withColumn("steps", F.lit(1))
    got = {}
    for r in folded(rows).collect():
        got.setdefault(r.conv_id, []).append((r.seq, r.role, r.text))
    assert {k: sorted(v) for k, v in got.items()} == replay(log)


def test_digests_of_formatted_turns(spark):
    rows = [
        (1, 0, "message", "a", "user", "q"),
        (1, 1, "message", "b", "assistant", "</s>é"),
        (1, 2, "message", "c", None, None),
        (None, 0, "message", "a", "assistant", "alone"),
    ]
    got = {r.conv_id: r for r in digests(formatted(spark.createDataFrame(rows, EVENTS))).collect()}
    text = "user\nq\nassistant\n</s>é\n\n\n"
    assert got[1].n_turns == 3
    assert got[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (
        5, hashlib.sha256("</s>é".encode()).hexdigest(),
    )
    assert got[None].loss_chars == 5
    none = spark.createDataFrame([], EVENTS)
    assert digests(formatted(none)).count() == 0


def test_long_runs_of_backslashes_take_linear_time():
    import time

    from linkwatch.llm.chat_format import escape, restore

    begun = time.time()
    for text in ("\\" * 1_000_000, "\\" * 500_000 + "</s>" + "\\" * 500_000):
        assert restore(escape(text)) == text
    assert escape("\\" * 9 + "</s>") == "\\" * 10 + "</s>"
    assert time.time() - begun < 20
