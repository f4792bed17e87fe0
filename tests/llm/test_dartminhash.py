from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from percepta.llm import dartminhash as dm
from tests.llm.conftest import ODD


def shingles(text, weighted=True):
    """The runs of five words; weighted: the n-th occurrence of a run is an element of its own."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    runs = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else {}
    return {(run, j) for run, n in runs.items() for j in range(n if weighted else 1)}


def brute_classes(rows, weighted=True):
    """Row number -> class (least row number), by comparing all pairs."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [shingles(r[1], weighted) for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            equal = rows[i][1] is not None and rows[i][1] == rows[j][1]
            both = len(sets[i] & sets[j])
            if equal or both and both >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(rows))]


def test_agreement_is_the_jaccard_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for shared, own in ((300, 40), (30, 30), (1, 0), (1500, 100)):
        a = np.sort(pool[: shared + own])
        b = np.sort(np.concatenate([pool[:shared], pool[shared + own : shared + 2 * own]]))
        k = 2048
        sig = dm.signatures([a, b], k=k)
        true = shared / (shared + 2 * own)
        assert abs((sig[0] == sig[1]).mean() - true) < 4.5 * (true * (1 - true) / k) ** 0.5 + 1e-9


def test_agreement_is_the_weighted_similarity():
    pool = np.arange(1, 41, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rng = np.random.default_rng(5)
    x, y = rng.uniform(0.1, 9, 40), rng.uniform(0.1, 9, 40)
    k = 4096
    sig = dm.signatures([pool, pool], [x, y], k=k)
    true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4.5 * (true * (1 - true) / k) ** 0.5


def test_agreement_of_heavy_elements():
    """Weights far apart, whose regions are cut into many parts."""
    pool = np.arange(1, 7, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = np.array([40_000.0, 3, 1, 700, 1, 1])
    y = np.array([36_000.0, 3, 2, 900, 1, 5])
    k = 4096
    sig = dm.signatures([pool, pool, pool[:1]], [x, y, np.array([2e6])], k=k)
    true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((sig[0] == sig[1]).mean() - true) < 4.5 * (true * (1 - true) / k) ** 0.5
    assert np.array_equal(sig[2], dm.signatures([pool[:1]], [np.array([2e6])], k=k)[0])
    for area in (1.0, 30.0, 256.0):
        drawn = dm._poisson(np.random.default_rng(1).random(20_000), area)
        assert abs(drawn.mean() - area) < 5 * (area / 20_000) ** 0.5
        assert abs(drawn.var() / area - 1) < 0.06


def test_occurrences():
    element, count = dm.shingle_counts(b"a b c d e a b c d e a b c d e f")
    assert sorted(count.tolist()) == [1, 2, 2, 2, 2, 3]
    every = dm.occurrences(element, count)
    assert len(set(every.tolist())) == 12 and set(element.tolist()) <= set(every.tolist())
    assert not len(dm.occurrences(*dm.shingle_counts(None)))


def test_signature_does_not_depend_on_the_batch():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 3, 50, 5000, 70_000)]
    together = dm.signatures(sets)
    for k, s in enumerate(sets):
        assert np.array_equal(together[k], dm.signatures([s])[0])
    assert not dm.signatures([np.zeros(0, np.uint64)]).any()


def vary(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = list(ODD)
    for group in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 30, 150, 600]))]
        for _ in range(6):
            rows.append((1000 + len(rows), vary(rng, base, rng.choice([0, 0, 1, 2, 4, 8]))))
    chain = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(30):  # every text is like the one before, the ends are not alike
        chain[rng.randrange(120)] = f"link{rng.randrange(10**6)}"
        rows.append((1000 + len(rows), " ".join(chain)))
    rng.shuffle(rows)
    return rows


def classes_of(rows, out):
    """(id, text) rows in classes, as a set of sorted id lists with the text's own nulls apart."""
    groups = {}
    for row, c in zip(rows, out, strict=True):
        groups.setdefault(c, []).append(str(row[0]))
    return sorted(sorted(g) for g in groups.values())


def test_classes_equal_all_pairs(clash, corpus):
    out = dm.near_report(clash(corpus)).collect()
    assert len(out) == len(corpus)
    want = classes_of(corpus, brute_classes(corpus))
    sizes = sorted((str(r.doc_id), r.class_size) for r in out)
    assert sizes == sorted((x, len(g)) for g in want for x in g)
    heads = sorted(str(r.doc_id) for r in out if r.is_first)
    assert len(heads) == len(want)
    for g in want:
        ids = [r for r in out if str(r.doc_id) in g and r.doc_id is not None]
        if ids and len(set(g)) == len(g):
            assert {r.class_id for r in ids} == {min(r.doc_id for r in ids)}


@pytest.fixture(scope="module")
def repetitive():
    """Texts of repeated lines, where similarity by weights and by sets differ both ways."""
    rng = random.Random(31)
    rows = []
    for _ in range(10):
        line = [f"w{rng.randrange(300)}" for _ in range(12)]
        rest = [f"w{rng.randrange(300)}" for _ in range(60)]
        for times in (1, 2, 10, 11, 12, 40):
            rows.append((len(rows), " ".join(line * times + rest)))
            rows.append((len(rows), vary(rng, line * times + rest, 3)))
    return rows


@pytest.mark.parametrize("weighted", [True, False])
def test_repeated_lines_equal_all_pairs(documents, repetitive, weighted):
    want = brute_classes(repetitive, weighted)
    assert want != brute_classes(repetitive, not weighted)
    out = dm.near_duplicates(documents(repetitive), weighted=weighted).collect()
    assert {r.id: r.class_id for r in out} == dict(enumerate(want))


def test_links_are_pairs_that_connect_the_classes(clash, corpus):
    links = [(r.a, r.b) for r in dm.near_links(clash(corpus)).collect()]
    text = {}
    for doc_id, t, *_ in corpus:
        if doc_id is not None:
            text.setdefault(doc_id, set()).add(t)
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if b is None:
            continue
        near = [(x, y) for x in text[a] for y in text[b] if x != y and x is not None and y is not None]
        sets = [(shingles(x), shingles(y)) for x, y in near]
        assert any(len(x & y) >= 0.8 * len(x | y) for x, y in sets)
        parent[max(find(a), find(b))] = min(find(a), find(b))
    made = [row[:2] for row in corpus if row[0] is not None and row[0] >= 1000]
    least = {}
    for doc_id, t in made:
        least[t] = min(doc_id, least.get(t, doc_id))
    got = {}
    for doc_id, t in made:
        got.setdefault(find(least[t]), set()).add(doc_id)
    want = {}
    for (doc_id, _), c in zip(made, brute_classes(made), strict=True):
        want.setdefault(c, set()).add(doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_large_group_goes_through_blocks(documents, monkeypatch):
    monkeypatch.setattr(dm, "BLOCK_TEXTS", 8)
    rng = random.Random(6)
    base = [f"w{rng.randrange(900)}" for _ in range(100)]
    rows = [(k, vary(rng, base, rng.choice([1, 2, 3, 5]))) for k in range(90)]
    out = dm.near_report(documents(rows)).collect()
    want = brute_classes(rows)
    assert {r.doc_id: r.class_id for r in out} == dict(enumerate(want))


def test_cells_let_all_texts_of_different_components_meet(spark):
    rng = random.Random(4)
    rows = []
    for band, tops, others in ((1, 60, 3), (2, 5, 40), (3, 1, 1), (4, 9, 0), (5, 30, 30)):
        start = 1000 * band
        rows += [(band, start + k, start, 10) for k in range(tops)]
        rows += [(band, start + 500 + k, start + 500 + k // rng.choice([1, 2]), 10) for k in range(others)]
    known = spark.createDataFrame(rows, "band long, uid long, comp long, bytes int")
    for most, most_bytes in ((7, 10**6), (10**6, 70), (10**6, 10**6)):
        cells = {}
        for r in dm.residual_cells(known, most, most_bytes).collect():
            cells.setdefault((r.band, r.i, r.j), []).append((r.uid, r.comp))
        met = {(b, x, y) for (b, _, _), c in cells.items() for x, cx in c for y, cy in c if x < y and cx != cy}
        want = {(b, x, y) for b, x, cx, _ in rows for c, y, cy, _ in rows if b == c and x < y and cx != cy}
        assert met == want
        assert all(len(c) == len(set(c)) for c in cells.values())
        assert max(map(len, cells.values())) < (4 * 7 if most == 7 or most_bytes == 70 else 80)
        # Blocks of the largest component do not meet each other.
        assert all(j >= 0 for _, _, j in cells)


def test_large_group_with_outsiders(documents, monkeypatch):
    monkeypatch.setattr(dm, "BLOCK_TEXTS", 8)
    rng = random.Random(16)
    base = [f"w{rng.randrange(900)}" for _ in range(200)]
    rows = [(k, vary(rng, base, 1)) for k in range(60)]
    rows += [(100 + k, vary(rng, base, e)) for k, e in enumerate([4, 6, 7, 8, 9, 10, 12, 30])]
    rng.shuffle(rows)
    out = dm.near_report(documents(rows)).collect()
    least = {}
    for (doc_id, _), c in zip(rows, brute_classes(rows), strict=True):
        least.setdefault(c, []).append(doc_id)
    assert {r.doc_id: r.class_id for r in out} == {x: min(g) for g in least.values() for x in g}


def test_kept_rows(clash, corpus):
    docs = clash(corpus)
    kept = dm.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = classes_of(corpus, brute_classes(corpus))
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert len(ids) == len(want)
    for g in want:
        numbers = [int(x) for x in g if x != "None"]
        if numbers and len(g) > 1:
            assert str(min(numbers)) in ids


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 99), (99, 100), (98, 100), (7, 7), (300, 200)]
    found = dm.components(spark.createDataFrame(edges, "a long, b long")).collect()
    want = {k: 0 for k in range(41)} | {98: 98, 99: 98, 100: 98, 300: 200, 200: 200}
    assert {r.uid: r.comp for r in found} == want and len(found) == len(want)


def test_empty_table(documents):
    assert dm.near_report(documents([])).collect() == []
    assert dm.drop_near_duplicates(documents([])).collect() == []
    assert dm.near_links(documents([])).collect() == []
    assert dm.components(documents([]).selectExpr("doc_id as a", "doc_id as b")).collect() == []
