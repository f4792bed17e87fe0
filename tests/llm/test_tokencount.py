from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from percepta.llm import tokencount
from tests.llm.conftest import MALFORMED, ODD, as_strings

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizers.path(tokencount.MODEL))


@pytest.fixture(scope="module")
def counter():
    return tokencount.Counter(tokencount.PieceTable(tokenizers.path(tokencount.MODEL)))


CASES = [
    "", " ", "  ", "a", "hello  world", "  hi ", "a\nb\tc\r\n", "</s>[INST] <unk> <0x41> <s>", "▁a ▁▁b", "\x00a\x7f",
    "é é ﬁ Ⅷ 🙂🙂", "a b　c​", "AAAA" * 40, "日本語の文章です。" * 30, "ab" * 500, " " * 100 + "x" + " " * 37,
    "the " * 100, "ththth" * 200, "0123456789" * 50, "internationalization" * 20, "=" * 333, "\n" * 50,
]


def test_cases_equal_the_library(library, counter):
    got = counter.count([t.encode() for t in CASES])
    assert got == [len(x) for x in library.encode(CASES)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(library, counter, text):
    assert counter.count([text.encode()]) == [len(library.encode(text))]


def test_long_units_without_spaces(library, counter):
    rng = random.Random(4)
    texts = ["".join(rng.choices(letters, k=6000)) for letters in ("ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz=/+0")]
    texts.append("".join(chr(c) for c in rng.choices(range(0x4E00, 0x9FFF), k=4000)))
    assert counter.count([t.encode() for t in texts]) == [len(x) for x in library.encode(texts)]


@pytest.mark.parametrize("unit", ["a", " ", "-", "ab", "- ", "the", "  x"])
def test_very_long_runs(library, counter, unit):
    """Rounds do not grow with the run: one merge a round would take hours here."""
    text = unit * (300_000 // len(unit))
    assert counter.count([text.encode()]) == [len(library.encode(text))]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "ab", " ", "-", "=", "th", "the", "in", "er", "é"]), st.integers(1, 40))))
def test_runs_equal_the_library(library, counter, runs):
    text = "".join(unit * n for unit, n in runs)
    assert counter.count([text.encode()]) == [len(library.encode(text))]


def test_operator(library, clash):
    rows = ODD + [(7, t) for t in CASES] + [(8, "long text " * 5000)]
    out = tokencount.token_report(clash(rows)).collect()
    want = sorted(
        (str(d), len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096)
        for d, t, *_ in rows
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out) == want


def test_empty_table(documents):
    assert tokencount.token_report(documents([])).collect() == []


def test_malformed_bytes_equal_the_library(spark, library):
    docs = as_strings(spark, list(enumerate(MALFORMED)), "doc_id long, text binary", "text")
    out = {r.doc_id: (r.n_bytes, r.n_tokens) for r in tokencount.token_report(docs).collect()}
    assert out == {
        k: (len(t), len(library.encode(t.decode("utf-8", "replace")))) for k, t in enumerate(MALFORMED)
    }
