from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from percepta.llm import chat
from tests.llm.conftest import MALFORMED, as_strings

SCHEMA = "conv_id long, turn long, role string, text string, pack string, path string"
PIECES = ["<", "|", ">", "\\", "s>", "/s>", "[", "INST]", "/INST]", "<SYS>>", "</SYS>>", "\n", "a", "é", "<|", "|>\n", "</s>"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_escape_is_reversible_and_breaks_controls(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(a + b in escaped for a, b in chat.CONTROLS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.sampled_from(PIECES), max_size=6).map("".join)] * 2), max_size=4))
def test_turns_round_trip(turns):
    formatted = "".join(chat.format_turn(*t)[0] for t in turns)
    assert chat.read_turns(formatted) == turns


def test_role_that_goes_on_from_the_opening_bar_is_read_back():
    turns = [(">\n", ""), (">\n|", "text"), ("|>\n", "<|>\n"), (">", "</s>"), ("assistant", "ok")]
    assert chat.read_turns("".join(chat.format_turn(*t)[0] for t in turns)) == turns


def digest(rows):
    by_conv: dict = {}
    for row in rows:
        by_conv.setdefault(row[0], []).append(row)
    out = []
    first = lambda v: (v is not None, v if v is not None else "")
    for conv, turns in by_conv.items():
        turns.sort(key=lambda r: ((r[1] is not None, r[1] or 0), first(r[2]), first(r[3])))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        size = sum(len(chat.format_turn(r[2] or "", r[3] or "")[0]) for r in turns)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        out.append((str(conv), len(turns), sha(whole), len(loss), sha(loss), size))
    return sorted(out)


def conversations():
    rows = []
    for conv in range(30):
        rows.append((conv, 0, "system", "shared start"))
        rows.append((conv, 1, "user", f"question {conv % 5} <|x|>"))
        for k in range(conv % 4):
            rows.append((conv, 2 + 2 * k, "assistant", f"answer {conv % 2} {k} </s>"))
            rows.append((conv, 3 + 2 * k, "user", f"more {k}"))
    rows += [(100, None, None, None), (100, 5, "assistant", None), (100, 5, "assistant", ""), (100, 5, "assistant", "x")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "fine"), (101, 0, "", "")]
    rows += [(102, 0, "user", "long " * 30_000), (102, 1, "assistant", "[INST]" * 5000)]
    rows += [(200 + k, 0, "assistant", "a copy") for k in range(12)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def test_digests_are_read_back(spark):
    rows = conversations()
    for most in (1, 3, 256):
        out = chat.read_packs(chat.pack_conversations(frame(spark, rows), most)).collect()
        got = sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in out)
        assert got == digest(rows)


def test_shared_turns_are_written_once(spark):
    rows = conversations()
    nodes = chat.pack_conversations(frame(spark, rows)).collect()
    turns = [r for r in nodes if r.kind == "turn"]
    by_conv: dict = {}
    for r in sorted((r for r in rows if r[0] is not None and r[0] < 30), key=lambda r: r[:2]):
        by_conv.setdefault(r[0], []).append(chat.format_turn(r[2], r[3])[0])
    prefixes = {tuple(t[:k]) for t in by_conv.values() for k in range(1, len(t) + 1)}
    tree = next(r.pack for r in turns if "shared start" in r.text)
    assert len([r for r in turns if r.pack == tree]) == len(prefixes)
    # Intervals: of the ancestors and the node, whose lengths add up to its position and length.
    for r in turns:
        assert sum(a.end - a.start for a in r.attend) == r.position + r.end - r.start
        assert r.attend[-1].end == r.end and r.end - r.start == len(r.text)
    for pack in {r.pack for r in turns}:
        own = sorted((r.start, r.end) for r in turns if r.pack == pack)
        assert own[0][0] == 0 and all(a[1] == b[0] for a, b in zip(own, own[1:], strict=False))


def test_packs_are_bounded(spark):
    rows = conversations()
    ends = [r for r in chat.pack_conversations(frame(spark, rows), 3).collect() if r.kind == "end"]
    sizes: dict = {}
    for r in ends:
        sizes[r.pack] = sizes.get(r.pack, 0) + 1
    assert len(ends) == len({r[0] for r in rows})
    # Subtrees keep to the bound; copies of one conversation are dealt by a hash, evenly on average.
    assert max(n for p, n in sizes.items() if p.startswith("t")) <= 3
    assert max(n for p, n in sizes.items() if p.startswith("c")) < 12


def test_hot_first_turn_is_shared(spark):
    """More conversations than a pack holds share the first turn and differ, or end, in the second."""
    rows = []
    for conv in range(1500):
        rows.append((conv, 0, "system", "hot start"))
        if conv % 10:
            rows.append((conv, 1, "user", f"question {conv if conv % 3 else conv // 300}"))
        if conv % 10 == 1:
            rows.append((conv, 2, "assistant", f"answer {conv}"))
    nodes = chat.pack_conversations(frame(spark, rows))
    out = nodes.collect()
    ends: dict = {}
    for r in out:
        if r.kind == "end":
            ends[r.pack] = ends.get(r.pack, 0) + 1
    assert sum(ends.values()) == 1500 and max(ends.values()) <= chat.PACK
    assert len([r for r in out if r.text and "hot start" in r.text]) == len(ends) <= 2 * -(-1500 // chat.PACK)
    # All that is below it is written once.
    deeper = [r.text for r in out if r.kind == "turn" and r.depth == 2]
    assert len(deeper) == len(set(deeper))
    got = sorted((str(r.conv_id), r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in chat.read_packs(nodes).collect())
    assert got == digest(rows)


def test_probe_and_empty_table(spark):
    out = chat.chat_report(spark, frame(spark, [])).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in out] == [(-7, 2, len(chat.PROBE))]
    assert out[0].loss_sha256 == hashlib.sha256(chat.PROBE.encode()).hexdigest()


def test_malformed_bytes_are_replacement_characters(spark):
    rows = [(k % 2, k, b"user\xff" if k % 3 else b"assistant", t) for k, t in enumerate(MALFORMED * 2)]
    turns = as_strings(spark, rows, "conv_id long, turn long, role binary, text binary", "role", "text")
    read = lambda b: b.decode("utf-8", "replace")
    out = chat.read_packs(chat.pack_conversations(turns)).drop("pack").collect()
    assert sorted((str(r.conv_id), *r[1:]) for r in out) == digest([(c, k, read(r), read(t)) for c, k, r, t in rows])


def test_hot_conversation_and_hot_null_id(spark):
    """One id, and the null id, hold most of all rows."""
    rows = [(1, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(8000)]
    rows += [(None, k, "assistant", f"turn {k}") for k in range(8000)] + [(k, 0, "user", "x") for k in range(2, 40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.read_packs(chat.pack_conversations(turns)).drop("pack").collect()
    assert sorted((str(r.conv_id), *r[1:]) for r in out) == digest(rows)
