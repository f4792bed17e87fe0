from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from percepta.llm import repeats
from tests.llm.conftest import ODD


def covered(texts, length):
    """For each text the flags of the bytes in windows that occur twice."""
    windows = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    flags = []
    for t in texts:
        f = [False] * len(t)
        for k in range(len(t) - length + 1):
            if windows[t[k : k + length]] > 1:
                f[k : k + length] = [True] * length
        flags.append(f)
    return flags


def brute(rows, length=400):
    out = []
    texts = [(t or "").encode() for _, t, *_ in rows]
    for (doc_id, *_), t, f in zip(rows, texts, covered(texts, length), strict=True):
        kept = bytes(b for b, x in zip(t, f, strict=True) if not x)
        spans = sum(x and not y for x, y in zip(f, [False, *f], strict=False))
        out.append((str(doc_id), len(t), sum(f), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=6, max_size=40).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=5))
def test_suffix_array_covers_all_repeats(blocks):
    spans = repeats.repeated_spans(blocks, 6)
    for block, found, want in zip(blocks, spans, covered(blocks, 6), strict=True):
        assert [any(s <= k < e for s, e in found) for k in range(len(block))] == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=4, max_size=25).map(lambda b: bytes(x % 2 + 97 for x in b)), min_size=1, max_size=3))
def test_groups_are_the_maximal_repeats(blocks):
    import numpy as np

    data = np.frombuffer(b"".join(blocks), dtype=np.uint8)
    ends = np.cumsum([len(b) for b in blocks])
    starts = np.concatenate([np.arange(e - len(b), e - 3) for b, e in zip(blocks, ends, strict=True)])
    left = np.concatenate([[-1], data[:-1].astype(int)])
    for k, (b, e) in enumerate(zip(blocks, ends, strict=True)):
        left[e - len(b)] = -1 - k
    tree = repeats.SuffixArray(data, ends, starts, 4)
    got = sorted((n, tuple(sorted(p.tolist()))) for n, p in tree.maximal_repeats(left))
    places: dict[bytes, list[int]] = {}
    for b, e in zip(blocks, ends.tolist(), strict=True):
        for i in range(len(b)):
            for j in range(i + 4, len(b) + 1):
                places.setdefault(b[i:j], []).append(e - len(b) + i)
    text = b"".join(blocks)
    end_of = {p: e for b, e in zip(blocks, ends.tolist(), strict=True) for p in range(e - len(b), e)}
    want = []
    for s, ps in places.items():
        after = {text[p + len(s)] if p + len(s) < end_of[p] else -p - 1 for p in ps}
        before = {int(left[p]) for p in ps}
        if len(ps) > 1 and len(after) > 1 and len(before) > 1:
            want.append((len(s), tuple(sorted(ps))))
    assert got == sorted(want)


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh é", k=rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(90), text(130), text(300), "x" * 900, "line again\n" * 80]
    rows = list(ODD)
    for k in range(40):
        parts = [text(rng.randint(1, 200)) for _ in range(3)]
        if k % 2:
            parts.insert(rng.randrange(4), rng.choice(passages))
        if k % 5 == 0:
            cut = rng.choice(passages)
            parts.insert(rng.randrange(4), cut[rng.randrange(100) : rng.randrange(300, 600)])
        rows.append((100 + k, "".join(parts)))
    rows += [(200 + k, rows[12 + k][1]) for k in range(4)]
    rows += [(300, rows[12][1] + text(50)), (301, "é" * 300), (302, "aé" * 300), (303, "z" * 399), (304, "q" * 400), (305, "q" * 400)]
    return rows


def run(df):
    out = repeats.repeat_report(df).collect()
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out)


def test_removed_bytes_equal_brute_force(clash):
    rows = corpus()
    want = brute(rows)
    assert sum(r[2] for r in want) > 10_000
    assert run(clash(rows)) == want


@pytest.mark.parametrize("group_bytes", [1500, 1])
def test_hot_anchors_are_split_until_they_fit(documents, group_bytes):
    """Group sizes that every anchor exceeds: all go through the finer levels."""
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdef ", k=700))
    rows = [(k, "".join(rng.choices("uvwxyz ", k=rng.randint(5, 300))) + passage[rng.randrange(200) :]) for k in range(30)]
    rows += [(100 + k, rows[k][1]) for k in range(3)]
    from pyspark.sql import functions as F

    from percepta.llm.common import TEXT, text_key

    docs = documents(rows)
    texts = docs.select(text_key("text").alias("tkey"), F.col("text").cast("binary").alias(TEXT))
    found = repeats.repeated(texts, group_bytes=group_bytes).collect()
    spans = {bytes(r.tkey): repeats.merged([s.asDict() for s in r.spans]) for r in found}
    for (_, t, *_), f in zip(rows, covered([r[1].encode() for r in rows], 400), strict=True):
        got = [False] * len(t)
        for s, e in spans.get(hashlib.md5(t.encode()).digest(), []):
            got[s:e] = [True] * (e - s)
        assert got == f


def test_as_text_drops_cut_characters(documents):
    tail = "b" * 500
    rows = [(1, "é1" + tail), (2, "é2" + tail), (3, None), (4, "kept")]
    out = {r.id: r.kept for r in repeats.remove_repeats(documents(rows), as_text=True).selectExpr("__row.doc_id as id", "kept").collect()}
    assert out == {1: "é1", 2: "é2", 3: "", 4: "kept"}


def test_empty_table(documents):
    assert run(documents([])) == []


def test_very_long_texts_are_cut_whole(documents):
    long = " ".join(str(k * k) for k in range(60_000))
    rows = [(1, long + "end"), (2, "start " + long[-5000:]), (3, long[200_000:200_500])]
    assert run(documents(rows)) == [
        ("1", len(long) + 3, 5500, 2, hashlib.sha256((long[:200_000] + long[200_500:-5000] + "end").encode()).hexdigest()),
        ("2", 5006, 5000, 1, hashlib.sha256(b"start ").hexdigest()),
        ("3", 500, 500, 1, hashlib.sha256(b"").hexdigest()),
    ]


def passages(text, flags):
    """(number, bytes) of the runs of flagged bytes with 50 words or more."""
    runs = [[]]
    for byte, flag in zip(text, flags, strict=True):
        if flag:
            runs[-1].append(byte)
        elif runs[-1]:
            runs.append([])
    long = [r for r in runs if len(bytes(r).split()) >= 50]
    return len(long), sum(map(len, long))


def test_passages_equal_brute_force(clash):
    """Passages of 50 words are found whether they have 400 bytes or not; shorter ones and lone texts are not."""
    rng = random.Random(4)
    text = lambda n: " ".join(f"term{rng.randrange(900)}" for _ in range(n))
    brief, medium, long = text(30), " ".join(f"w{k}" for k in range(52)), text(90)
    rows = corpus(2) + [(600, text(300)), (601, f"{text(40)} {brief} {text(40)}"), (602, f"{brief} {text(60)}")]
    rows += [(603 + k, f"{text(90)} {medium} {text(90)}") for k in range(2)]
    rows += [(605 + k, f"{text(20)} {long} {text(30)}") for k in range(2)]
    out = repeats.repeat_report(clash(rows)).collect()
    texts = [(t or "").encode() for _, t, *_ in rows]
    flags = covered(texts, repeats.PASSAGE_BYTES)
    want = sorted((str(r[0]), *passages(t, f)) for r, t, f in zip(rows, texts, flags, strict=True))
    assert sorted((str(r.doc_id), r.n_passages, r.passage_bytes) for r in out) == want
    assert all(r.has_passage == (r.n_passages > 0) for r in out)
    by_id = {r.doc_id: r for r in out}
    assert [by_id[k].has_passage for k in range(600, 607)] == [False] * 3 + [True] * 4
    assert [by_id[k].n_removed > 400 for k in range(603, 607)] == [False] * 2 + [True] * 2
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == brute(rows)


def test_sieve_keeps_all_that_share_a_window():
    """Contexts of one anchor, and those among them that differ near it from all others."""
    rng = random.Random(5)
    text = lambda n: bytes(rng.choices(b"abcd", k=n))
    anchor, rows = text(8), []
    for _ in range(300):
        left, right = text(rng.randint(0, 32)), text(rng.randint(0, 32))
        if len(left) + len(right) < 32:
            continue
        if rows and rng.random() < 0.5:  # bytes around the anchor from another context
            _, _, data, off = rng.choice(rows)
            near = rng.randint(0, 32)
            left = left[: max(len(left) - near, 0)] + data[max(off - near, 0) : off]
            right = data[off + 8 : off + 8 + 32 - near] + right[32 - near :]
        if len(left) + len(right) >= 32:
            rows.append((1, len(rows), left + anchor + right, len(left)))
    spans = repeats.repeated_spans([r[2] for r in rows], 40)
    near = repeats.sieve(rows, 40, 8)
    assert len(near) < len(rows) and {r[1] for r, s in zip(rows, spans, strict=True) if s} <= {r[1] for r in near}
    assert repeats.repeated_spans([r[2] for r in near], 40) == [spans[r[1]] for r in near]


def test_runs_are_the_merged_spans():
    import pyarrow as pa

    rng = random.Random(1)
    kind = pa.list_(pa.struct([("los", pa.list_(pa.int32())), ("s", pa.int32()), ("e", pa.int32())]))
    span = lambda s: {"los": rng.choices(range(300), k=rng.randint(1, 3)), "s": s, "e": s + rng.randint(1, 30)}
    rows = [[span(rng.randrange(20)) for _ in range(rng.randint(1, 6))] for _ in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array([b"k"] * 300), pa.array(rows, kind)], names=["tkey", "spans"])
    for part, texts in ((batch, rows), (batch.slice(100, 50), rows[100:150])):
        got = next(repeats._runs(iter([part]))).column(1).to_pylist()
        assert [[(r["s"], r["e"]) for r in runs] for runs in got] == [repeats.merged(t) for t in texts]
