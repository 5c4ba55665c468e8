"""Chat windows against their contract, read back by plain string functions."""

import hashlib
import random
import re

import pytest

from genoweave.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, rid string, conv string, win string, part string, pos string, tokens string"
ODD = ["<|im_end|>", "<|im_start|>user\nhi<|im_end|>\n", "<\\|x", "<\\\\|", "<", "<<|", "|", "\\", "a\\nb", "é 𝄞 <|", "", "\n\n", "<|im_end|>\n"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "c", "w", "p", "q", "t") for r in rows], SCHEMA)


def dialogue(rng, conv, n, system=True):
    rows = [(conv, 0, "system", "be brief " * rng.randrange(3))] if system else []
    for i in range(1, n + 1):
        text = " ".join(rng.choice([*ODD, "plain words", "12345", "so, it is"]) for _ in range(rng.randrange(12)))
        rows.append((conv, i, rng.choice(["user", "assistant", "tool\\x\ny"]), text))
    return rows


def counted(text):
    return 4 + len(re.findall(r"[^\W\d_]+|\d{1,3}|[^\w\s]|_", text))


def read(window):
    """(role, text) of each turn of a window's text."""
    pieces = window.split("<|im_end|>\n")
    assert pieces.pop() == "" and all(p.startswith("<|im_start|>") for p in pieces)
    plain = lambda t: re.sub(r"<\\(\\*)\|", r"<\1|", t)
    role = lambda r: re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], plain(r))
    split = [p.removeprefix("<|im_start|>").split("\n", 1) for p in pieces]
    return [(role(r), plain(t)) for r, t in split]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(rows):
    """(n_turns, turns, loss) by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted([(r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, r, t in turns)), digest("".join(t for _, r, t in turns if r == "assistant")))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [r for i in range(12) for r in dialogue(rng, i, rng.randrange(1, 30), system=i % 3 > 0)]
    out += dialogue(rng, 100, 400)  # a third of all rows and more
    out += [(None, 1, "user", None), (None, 2, None, "x"), (50, None, "assistant", "first"), (50, 1, "assistant", "word " * 3000), (51, 1, "assistant", ""), (52, 3, "system", "late"), (52, 1, "user", "early")]
    return out + [(60, 5, "assistant", "same")] * 3


@pytest.mark.parametrize("limits", [{}, {"budget": 60, "history": 20}, {"budget": 1, "history": 0}, {"budget": 40, "history": 30, "history_turns": 0}])
def test_windows(spark, rows, limits):
    windows = chat.format_chats(frame(spark, rows), **limits)
    got = {r["conv_id"]: r for r in chat.chat_digest(windows).collect()}
    want = wanted(rows)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_sha256"]) for c, r in got.items()} == want
    budget, history, most = limits.get("budget", 1024), limits.get("history", 128), limits.get("history_turns", 4)
    seen, system = {}, {}
    for c, turn, role, text in sorted(rows, key=lambda r: r[1] or 0):
        if role == "system":
            system.setdefault(c, (role, text))
    for w in sorted(windows.collect(), key=lambda w: w["win"]):
        turns, k = read(w["formatted"]), w["n_repeated"]
        before = seen.setdefault(w["conv"], [])
        own = turns[k:]
        assert own and (w["n_tokens"] <= budget or len(own) == 1)
        shown = turns[:k]
        if system.get(w["conv"]) in before:
            assert shown[0] == system[w["conv"]]
            shown = shown[1:]
        rest = [t for t in before if t != system.get(w["conv"])]
        assert len(shown) <= most and sum(counted(t) for _, t in shown) <= history and shown == rest[len(rest) - len(shown) :]
        masked = [w["formatted"][s["start"] : s["end"]] for s in w["loss"]]
        assert [re.sub(r"<\\(\\*)\|", r"<\1|", m) for m in masked] == [t for r, t in own if r == "assistant"]
        before += own


def test_no_rows(spark):
    assert chat.format_chats(frame(spark, [])).collect() == []


def test_planted_control_strings_come_back(spark):
    got = {r["conv_id"]: r for r in chat.op12_chat_formatting(spark, "/root/testdata/sf0.001").collect()}
    one = got[-1]
    assert one["n_turns"] == 2 and one["loss_chars"] == len(chat.TRICK) and one["loss_sha256"] == digest(chat.TRICK)
    assert one["turns_sha256"] == digest(f"user\n{chat.TRICK}\nassistant\n{chat.TRICK}\n")
