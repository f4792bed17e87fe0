from __future__ import annotations

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from percepta.llm import repeat_groups, repeats
from tests.llm.conftest import MALFORMED, ODD, as_strings
from tests.llm.test_repeats import corpus, covered


def places_of(part: bytes, texts: list[bytes]) -> set[tuple[int, int]]:
    found = set()
    for k, text in enumerate(texts):
        at = text.find(part)
        while at >= 0:
            found.add((k, at))
            at = text.find(part, at + 1)
    return found


def check(texts: dict[int, bytes], rows, length: int):
    """Every group is a repeated string with all its occurrences; together they cover what repeats."""
    names = list(texts)
    whole = list(texts.values())
    groups = defaultdict(list)
    for r in rows:
        groups[r.key, r.number].append((names.index(r.id), r.start, r.length))
    seen = set()
    flags = [[False] * len(t) for t in whole]
    for spots in groups.values():
        parts = {whole[k][start : start + size] for k, start, size in spots}
        assert len(parts) == 1 and len(spots) == len(set(spots)) > 1
        part = parts.pop()
        assert len(part) >= length and part not in seen
        seen.add(part)
        assert {(k, start) for k, start, _ in spots} == places_of(part, whole)
        for k, start, size in spots:
            flags[k][start : start + size] = [True] * size
    assert flags == covered(whole, length)
    return groups


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.binary(min_size=4, max_size=25).map(lambda b: bytes(x % 2 + 97 for x in b)), min_size=1, max_size=4, unique=True),
    st.lists(st.booleans(), min_size=4, max_size=4),
)
def test_context_groups_are_repeats_with_all_places(contexts, twice):
    twice = twice[: len(contexts)]
    found = defaultdict(set)
    for size, spots in repeat_groups.context_groups(contexts, twice, 4):
        parts = {contexts[k][at : at + size] for k, at in spots}
        assert len(parts) == 1
        part = parts.pop()
        assert part not in found
        found[part] = set(spots)
        assert found[part] == places_of(part, contexts)
        assert len(spots) > 1 or twice[spots[0][0]]
    flags = [[any(k == j and at <= x < at + len(p) for p, s in found.items() for j, at in s) for x in range(len(c))] for k, c in enumerate(contexts)]
    copies = contexts + [c for c, again in zip(contexts, twice, strict=True) if again]
    assert flags == covered(copies, 4)[: len(contexts)]


def test_groups_of_a_table(clash):
    rows = [r for r in corpus() if r[1] and r[0] is not None and r[0] >= 100]
    texts = {d: t.encode() for d, t, *_ in rows}
    out = repeat_groups.repeat_groups(clash(rows + ODD)).collect()
    groups = check(texts, out, 400)
    assert max(len(s) for s in groups.values()) > 4


@pytest.mark.parametrize("group_bytes", [3000, 1])
def test_groups_of_anchors_that_are_split(documents, group_bytes):
    rng = random.Random(10)
    passage = "".join(rng.choices("abcdef ", k=700))
    rows = [(k, "".join(rng.choices("uvwxyz ", k=rng.randint(5, 300))) + passage[rng.randrange(200) :]) for k in range(20)]
    rows += [(100 + k, rows[k][1]) for k in range(3)]
    out = repeat_groups.repeat_groups(documents(rows), group_bytes=group_bytes, block_bytes=1).collect()
    check({d: t.encode() for d, t in rows}, out, 400)


def test_groups_cover_what_is_removed(documents):
    rows = [r for r in corpus(2) if r[1] and r[0] is not None and r[0] >= 100]
    docs = documents(rows)
    removed = {r["__row"].doc_id: r.n_removed for r in repeats.remove_repeats(docs).collect()}
    bytes_of = defaultdict(set)
    for r in repeat_groups.repeat_groups(docs).collect():
        bytes_of[r.id].update(range(r.start, r.start + r.length))
    assert {d: len(bytes_of[d]) for d in removed} == removed


def test_long_null_repeated_and_malformed_rows(spark):
    long = b"".join(b"%d " % (k * k) for k in range(30_000))
    rows = [(1, long), (2, b"\xff" + long), (None, MALFORMED[2] * 60), (None, MALFORMED[2] * 60), (3, None), (4, b"")]
    docs = as_strings(spark, rows, "doc_id long, text binary", "text")
    out = repeat_groups.repeat_groups(docs).collect()
    spans = defaultdict(set)
    for r in out:
        spans[r.id].update(range(r.start, r.start + r.length))
    assert len(spans[1]) == len(spans[2]) == len(long) and set(spans) == {1, 2, None}


def test_empty_table(documents):
    assert repeat_groups.repeat_groups(documents([])).collect() == []
