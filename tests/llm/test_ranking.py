from __future__ import annotations

import random

import numpy as np
import pytest

from percepta.llm import ranking
from tests.llm.conftest import ODD

VOCABULARY = [f"w{'aeiou'[k % 5]}{k:x}r" for k in range(300)]


def good(rng):
    return "\n".join(" ".join(rng.choices(VOCABULARY, k=rng.randint(6, 15))) + "." for _ in range(rng.randint(2, 12)))


def bad(rng):
    kind = rng.randrange(4)
    words = rng.choices(VOCABULARY, k=rng.randint(30, 90))
    if kind == 0:
        return " ".join(w + rng.choice(["###", "***", "&&&"]) for w in words)
    if kind == 1:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 2:
        return "\n".join([" ".join(words[:8])] * 30)
    return " | ".join(words)


def table(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        y = int(rng.random() < 0.75)
        rows.append((k, good(rng) if y else bad(rng)))
        if k % 3:
            labels.append((k, y, 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_odd_rows(spark, clash):
    rows, labels = table(1, 900)
    odd = [(None if d[0] is None else 5000 + d[0], *d[1:]) for d in ODD] + [(6000, "word " * 40_000)]
    more = [(None, 1, 0), (5001, 0, 0), (5002, None, 0), (labels[0][0], labels[0][1], 1), (777_777, 1, 1)]
    out = ranking.quality_report(clash(rows + odd), spark.createDataFrame(labels + more, LABELS)).collect()
    assert len(out) == len(rows) + len(odd)
    truth = {d: y for d, y, _ in labels}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 100
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    pos = [r.score for r in held if truth[r.doc_id]]
    neg = [r.score for r in held if not truth[r.doc_id]]
    assert np.mean([[p > n for n in neg] for p in pos]) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_scores_do_not_depend_on_ids_or_sources(spark, documents):
    rows, labels = table(2, 200)
    docs = documents(rows)
    ranker = ranking.fit_ranker(docs, spark.createDataFrame(labels, LABELS))
    a = sorted(r.score for r in ranking.score_documents(docs, ranker).collect())
    other = documents([(-d, t, "zz", "elsewhere") for d, t in rows]).repartition(5)
    assert a == pytest.approx(sorted(r.score for r in ranking.score_documents(other, ranker).collect()))


def test_weights_solve_the_pairwise_problem(spark, documents, monkeypatch):
    """At the optimum the gradient of the regularized pairwise loss vanishes."""
    kept = {}

    def keep(df, name):
        kept[name] = df.cache()
        return kept[name]

    rows, labels = table(3, 300)
    # A tenth of the labels are wrong, so that no weights meet all preferences.
    labels = [(d, 1 - y if d % 10 == 1 else y, z) for d, y, z in labels]
    docs, marks = documents(rows), spark.createDataFrame(labels, LABELS)
    monkeypatch.setattr(ranking, "materialize", keep)
    ranker = ranking.fit_ranker(docs, marks)
    pairs = kept["pairs"].collect()
    x = np.array([r.features.toArray() for r in pairs])
    y = np.array([r.label for r in pairs])
    count = sum(q for _, q, _ in labels)
    assert len(pairs) == ranking.PAIRS * max(count, len(labels) - count)

    def gradient(w):
        return x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + ranking.STRENGTH * w

    at_start = np.linalg.norm(gradient(np.zeros(x.shape[1])))
    assert at_start > 0.1 and np.linalg.norm(gradient(ranker.weights)) < 0.005 * at_start


def test_preferences_hold_for_nearly_all_pairs(spark, documents):
    rows, labels = table(3, 300)
    ranker = ranking.fit_ranker(documents(rows), spark.createDataFrame(labels, LABELS))
    truth = {d: y for d, y, _ in labels}
    raw = {d: ranker.raw(np.array(ranking.features(t.encode()))) for d, t in rows if d in truth}
    margin = np.subtract.outer([raw[d] for d in raw if truth[d]], [raw[d] for d in raw if not truth[d]])
    assert (margin > 0).mean() > 0.99


def test_sample_bounds_what_is_learned_from(spark, documents):
    rows, labels = table(4, 300)
    ranker = ranking.fit_ranker(documents(rows), spark.createDataFrame(labels, LABELS), sample=60)
    y = np.array([q for _, q, _ in labels])
    text = dict(rows)
    score = ranker.score(np.array([ranking.features(text[d].encode()) for d, _, _ in labels]))
    assert ((score >= 0.5) == (y == 1)).mean() > 0.85


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 0, 0)]])
def test_one_label_or_none_rejects_nothing(spark, clash, labels):
    docs = clash([(1, "some text"), (2, "other text"), (3, None)])
    out = ranking.drop_low_quality(docs, spark.createDataFrame(labels, LABELS))
    assert out.columns == docs.columns and out.count() == 3


def test_empty_table(spark, documents):
    assert ranking.quality_report(documents([]), spark.createDataFrame([(1, 1, 0)], LABELS)).collect() == []
