from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from percepta.llm import decontam
from tests.llm.conftest import ODD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(text, items, window=10):
    row, hit, found = words(text), set(), set()
    for name, item in items:
        w = words(item)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            for p in range(len(row) - n + 1):
                if row[p : p + n] == w[k : k + n]:
                    hit.update(range(p, p + n))
                    found.add(name)
    return len(row), len(hit), sorted(found)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.text(alphabet="abA é-", max_size=40), max_size=4),
    st.text(alphabet="abA é-", max_size=80),
    st.integers(1, 6),
)
def test_search_equals_brute_force(items, text, window):
    named = [(str(k), t) for k, t in enumerate(items)]
    tables = decontam.TestStrings([(n, t.encode()) for n, t in named], window)
    row = decontam.plain_words(text.encode())
    spans, found = tables.search(row)
    hit = {p for s, e in spans for p in range(s, e)}
    assert (len(row), len(hit), sorted(tables.names[k] for k in found)) == brute(text, named, window)


ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "short item"),
    (3, None),
    (4, "!!!"),
    (None, "no id here"),
    (2, "short item"),
]


def report(spark, docs, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_contamination(docs, bench, **more)
    rows = found.select("__row.doc_id", "n_words", "n_hit", "items").collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows), key=repr)


def test_odd_rows_and_clashing_columns(spark, clash):
    text = "x one two THREE four-five six seven eight nine ten short item no id here"
    docs = ODD + [(7, text), (8, "one two three four five six seven eight nine"), (9, "word " * 5000 + text)]
    named = [("null" if k is None else str(k), t) for k, t in ITEMS]
    want = sorted(
        ((d[0], *brute(d[1], named)[:2], tuple(brute(d[1], named)[2])) for d in docs), key=repr
    )
    assert report(spark, clash(docs), ITEMS) == want
    # Blocks of one item or so give the same.
    assert report(spark, clash(docs), ITEMS, block_bytes=20) == want


def test_empty_tables(spark, documents):
    assert report(spark, documents([]), ITEMS) == []
    assert [r[2] for r in report(spark, documents([(1, "a b")]), [])] == [0]


def test_drop_keeps_all_columns(spark, clash):
    docs = clash([(1, "a short item there"), (2, "clean words"), (3, None)])
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_every_scan_has_its_own_tables(spark, documents):
    """Workers keep tables between tasks; other benchmarks must not meet them."""
    docs = documents([(k, f"some text with word{k} inside") for k in range(6)])
    for k in range(6):
        found = report(spark, docs, [(k, f"word{k} inside")])
        assert [r[0] for r in found if r[2]] == [k]


def test_repeated_items_are_shipped_once(spark, documents, monkeypatch):
    """Equal rows of a benchmark share a block: they neither fill it nor make more blocks."""
    shipped, scan = [], decontam._scan
    monkeypatch.setattr(decontam, "_scan", lambda df, items, *a, **k: shipped.append(items) or scan(df, items, *a, **k))
    items = [(1, "an item that comes often")] * 500 + [(k, f"item number{k}") for k in range(2, 20)]
    docs = documents([(1, "here an item that comes often is"), (2, "item number7"), (3, "none")])
    got = report(spark, docs, items, block_bytes=500)
    assert got == [(1, 7, 5, ("1",)), (2, 2, 2, ("7",)), (3, 1, 0, ())]
    assert [sorted(s) for s in shipped] == [sorted({(str(k), t.encode()) for k, t in items})]
    assert report(spark, docs, items, block_bytes=100) == got
    rest = [item for s in shipped[1:] for item in s]
    assert len(shipped) > 2 and len(rest) == len(set(rest)) == 19
