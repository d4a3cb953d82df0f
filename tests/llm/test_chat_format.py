"""Folding of event logs, rendering, and reading back."""

import hashlib

from eventlens.llm.chat_format import digest, fold_events, read_back, render

LOG = "conv_id long, seq long, kind string, target long, role string, text string, chunk long, piece string"


def log_of(spark, rows):
    return spark.createDataFrame([(*r, 0, "x") for r in rows], LOG)


def brute_fold(rows):
    """Final (role, text) lists by conversation, event by event."""
    rank = lambda v: (v is not None, v)
    result = {}
    for conv in {r[0] for r in rows}:
        events = sorted(
            (r for r in rows if r[0] == conv),
            key=lambda r: ((r[1] is not None, r[1] or 0), rank(r[4]), r[5] or "", r[2] or "message"),
        )
        messages, last = [], None
        for _, seq, kind, target, role, text in events:
            kind, text = kind or "message", text or ""
            if not messages or kind == "message":
                last = {"seq": seq, "role": role, "text": text}
                messages.append(last)
                continue
            at = next((m for m in messages if target is not None and m["seq"] == target), None if target is not None else last)
            if kind == "delta":
                at["text"] += text
            else:
                at["text"] = text
            if kind == "regenerate":
                del messages[messages.index(at) + 1 :]
                last = at
        result[conv] = [(m["role"] or "", m["text"]) for m in messages]
    return result


EVENTS = [
    (1, 0, None, None, "user", "hi"),
    (1, 1, "message", None, "assistant", ""),
    (1, 2, "delta", None, None, "he"),
    (1, 3, "delta", None, None, "llo"),
    (1, 4, "edit", 0, None, "hi there"),
    (1, 5, "message", None, "user", "again"),
    (1, 6, "message", None, "assistant", "no"),
    (1, 7, "regenerate", 1, None, ""),
    (1, 8, "delta", None, None, "better"),
    (1, 9, "message", None, "user", "thanks"),
    (1, 10, "edit", 1, None, "best"),
    (1, 11, "delta", 1, None, "!"),
    (2, 5, "delta", None, "assistant", "a delta opens the conversation"),
    (2, 6, "delta", None, None, ", and goes on"),
    (3, None, "message", None, None, None),
    (3, 1, "message", None, "user", "</s><s>\\s \\l\n"),
    (3, 1, "message", None, "user", "</s><s>\\s \\l\n"),
    (None, 0, "message", None, "as\nsis<s>tant", "x"),
]


def turns(df):
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in df.collect()}


def test_fold_against_brute_force(spark):
    rendered = render(fold_events(log_of(spark, EVENTS)))
    assert turns(read_back(rendered)) == brute_fold(EVENTS)


def test_long_conversation(spark):
    rows = [(7, i, "message", None, ("user", "assistant")[i % 2], f"m{i} ") for i in range(2000)]
    rows += [(7, 2000 + i, "delta", 1999, None, f"d{i}") for i in range(600)]
    rows += [(7, 3000, "regenerate", 1501, None, "cut here"), (7, 3001, "delta", None, None, " end")]
    rendered = render(fold_events(log_of(spark, rows)))
    assert turns(read_back(rendered)) == brute_fold(rows)


def test_mask_and_digest(spark):
    row = digest(render(fold_events(log_of(spark, EVENTS)))).where("conv_id = 1").first()
    want = brute_fold(EVENTS)[1]
    loss = "".join(t for r, t in want if r == "assistant")
    assert row.n_turns == len(want)
    assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
    assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_empty_log(spark):
    assert digest(render(fold_events(log_of(spark, [])))).count() == 0
