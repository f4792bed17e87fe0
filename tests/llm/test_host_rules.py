from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from percepta.llm import host_rules
from tests.llm.conftest import MALFORMED, ODD, as_strings


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    again = {
        k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines),
        len(lines) - len(set(lines)),
        len(again),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t#|\x85\xa0", max_size=200))
def test_measures_equal_brute_force(text):
    assert host_rules.measure(text.encode()) == brute(text)


def test_repeated_windows_overlap():
    text = "a b c d e f g h x a b c d e f g h " + "z " * 20
    assert host_rules.measure(text.encode()) == brute(text)


GOOD = "plain words in a clean text of more than twenty words " * 1 + " ".join(
    f"word{k}" for k in range(30)
)
JUNK = " ".join(f"jnk{k}###" for k in range(40))


def test_host_verdicts_and_odd_rows(clash):
    rows = (
        ODD
        + [(100 + k, GOOD, "en", "good") for k in range(20)]
        + [(200 + k, JUNK, "en", "bad") for k in range(19)]
        + [(300, GOOD, "en", "bad"), (301, JUNK, "en", "good"), (302, "word " * 20_000, "en", "good")]
    )
    out = host_rules.host_quality(clash(rows)).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out if r.doc_id is not None}
    assert all(kept[100 + k] for k in range(20))
    assert not any(kept[200 + k] for k in range(19))
    assert not kept[300]  # its host is rejected
    assert not kept[301]  # it fails a rule itself
    assert not kept[302]  # one word again and again
    assert not kept[1] and not kept[2] and not kept[3]
    by_id = {r.doc_id: r for r in out}
    assert by_id[302].n_repeat_words == 20_000 and by_id[302].base_failed


def test_prior_shrinks_small_hosts(spark):
    rows = [("a", k < 100) for k in range(1000)] + [("b", k < 120) for k in range(1000)] + [("c", True)]
    rates = {
        r.host: r for r in host_rules.host_rates(spark.createDataFrame(rows, "host string, failed boolean")).collect()
    }
    assert abs(rates["a"].rate - 0.1) < 0.02
    assert rates["c"].rate < 0.9  # one failure of one document is not a rate of 1


@pytest.mark.parametrize("rows", [[], [("a", True)], [("a", False), ("b", False)], [(None, True), (None, False)]])
def test_degenerate_hosts(spark, rows):
    rates = host_rules.host_rates(spark.createDataFrame(rows, "host string, failed boolean")).collect()
    assert len(rates) == len({h for h, _ in rows})
    assert all(0 <= r.rate <= 1 for r in rates)


def test_empty_table(documents):
    assert host_rules.host_quality(documents([])).collect() == []


@pytest.mark.parametrize("text", MALFORMED)
def test_malformed_bytes_count_as_replacement_characters(text):
    assert host_rules.measure(text) == brute(text.decode("utf-8", "replace"))


def test_malformed_rows(spark):
    rows = [(k, t, b"host\xff") for k, t in enumerate(MALFORMED)]
    docs = as_strings(spark, rows, "doc_id long, text binary, source binary", "text", "source")
    out = {r.doc_id: r for r in host_rules.host_quality(docs).collect()}
    for k, text in enumerate(MALFORMED):
        r = out[k]
        n, chars, symbols, _, dup, again = brute(text.decode("utf-8", "replace"))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, again)
