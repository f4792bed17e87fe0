from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from percepta.llm import langid
from tests.llm.conftest import ODD


def slow_profile(text):
    """The sum of bound vectors, gram by gram."""
    chars, last = [32], False
    for c in f" {text.lower()} ":
        if c.isalpha():
            chars.append(ord(c))
        elif chars[-1] != 32:
            chars.append(32)
    if chars[-1] != 32:
        chars.append(32)
    total = np.zeros(langid.DIMENSIONS)
    for k in range(len(chars) - 2):
        bound = np.ones(langid.DIMENSIONS)
        for j in range(3):
            bound = bound * np.roll(langid.letter_vector(chars[k + j]).astype(float), j)
        total += bound
    return total


def test_profiles_equal_the_definition():
    texts = ["Abba, der Hase!", "", "12 . 3", "x", "日本語 текст", "aaaa " * 50, "\U0001f642é"]
    text, number, parts, has = langid.grams(texts)
    profiles = langid.bundle(langid._counts(text, number, len(texts), parts.shape[1]), parts)
    for k, t in enumerate(texts):
        assert has[k] == any(c.isalpha() for c in t)
        if has[k]:
            assert np.array_equal(profiles[k], slow_profile(t))


def test_letter_vectors_are_fixed():
    first = langid.letter_vector(97).copy()
    langid._LETTERS.clear()
    assert np.array_equal(first, langid.letter_vector(97))
    assert set(np.unique(first)) == {-1, 1}


SYLLABLES = {"xx": "ka ti ro mu".split(), "yy": "sch bre lon gur".split(), "zz": "qua vie eau oux".split()}


def make(seed, n, words=40):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(words))
        rows.append((k, text, lang))
    return rows


def test_held_out_accuracy_and_odd_rows(clash):
    rows = make(1, 200)
    odd = [(None if d[0] is None else 1000 + d[0], *d[1:]) for d in ODD] + [(2000, "karotimu " * 20_000, None)]
    out = langid.language_report(clash(rows + odd)).collect()
    assert len(out) == len(rows) + len(odd)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in out if r.doc_id in truth and r.held_out]
    assert len(held) > 20 and all(r.lang_pred == truth[r.doc_id] for r in held)
    got = Counter(r.lang_pred for r in out if r.doc_id in (1001, 1002, 1003, 1006))
    assert got == {"und": 4}
    assert next(r for r in out if r.doc_id == 2000).lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out} <= {"xx", "yy", "zz", "en", "de", "und"}


def test_blocks_of_languages_give_what_one_block_gives(documents, monkeypatch):
    rows = [(k, t, f"{x}{k % 3}") for k, t, x in make(3, 60)] + [(100, "1 2", None), (101, None, "q")]
    docs = documents(rows)

    def result(most):
        out = langid.identify(docs, docs, most=most).collect()
        return {r["__row"].doc_id: r.lang_pred for r in out}, {r["__row"].doc_id: r.score for r in out}

    whole = result(100)
    assert len(whole[0]) == len(rows) and len(set(whole[0].values())) > 4

    def same(most):
        langs, scores = result(most)
        return langs == whole[0] and scores == pytest.approx(whole[1], abs=1e-5)

    assert same(2) and same(3) and same(9)
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)  # sums leave a task in parts
    assert same(4)


def test_prediction_is_the_largest_cosine(documents):
    rows = make(4, 30, words=6)
    units = {}
    for x in sorted(SYLLABLES):
        total = sum(slow_profile(t) for _, t, lang in rows if lang == x)
        units[x] = total / np.linalg.norm(total)
    docs = documents(rows)
    for r in langid.identify(docs, docs).collect():
        profile = slow_profile(r["__row"].text)
        cosine = {x: float(u @ profile / np.linalg.norm(profile)) for x, u in units.items()}
        best = max(cosine, key=lambda x: cosine[x])
        assert r.lang_pred == best and abs(r.score - cosine[best]) < 1e-5


def test_malformed_bytes(spark):
    rows = spark.range(8).selectExpr(
        "id AS doc_id", "CAST(unhex('6B61FF7469') AS string) AS text", "CAST(unhex('78FF') AS string) AS lang"
    )
    assert {r.lang_pred for r in langid.language_report(rows).collect()} == {"x\ufffd"}


def test_nothing_to_learn(documents):
    assert langid.language_report(documents([])).collect() == []
    rows = [(k, "some words", None) for k in range(8)]
    assert {(r.lang_pred, r.score) for r in langid.language_report(documents(rows)).collect()} == {("und", 0.0)}
