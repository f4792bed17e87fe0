"""Quality classifier by Bradley-Terry pairwise ranking.

Each text is a vector of measures of its whole length. A document labelled 1
is preferred to one labelled 0; the scores that explain the preferences best
are learned by logistic loss on the differences of the two vectors (Spark
ML's logistic regression without intercept). The threshold is the quantile of
the training scores that tells the labels apart best, and lies at 0.5 after a
sigmoid.

Scale: the labelled rows to learn from are a sample of at most ``SAMPLE``
rows, chosen by a hash of the id, so their join with the documents is a
broadcast of bounded size and no text is shuffled. Scoring is one narrow
stage over all documents.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import ROW, TEXT, add_columns, field, id_crc, materialize, texts_of, with_row

#: At most so many labelled documents are learned from.
SAMPLE = 16_000
#: Preference pairs for each document of the larger class.
PAIRS = 4
STRENGTH = 1e-4

FEATURES = (
    "log_words", "word_chars", "symbols", "upper", "digits", "exclaims", "commas", "stops", "pipes",
    "dup_lines", "distinct_words", "top_word", "same_next", "line_words", "non_letters", "capital_words",
    "long_words", "has_words",
)
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_KEEP_DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)
_SYMBOLS = bytes(c for c in range(256) if c not in b"#*$%&<>=@^~_+\\{}[]")
_LETTERS = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122 or c >= 128))


def features(text: bytes | None) -> list[float]:
    """The ``FEATURES`` of one text; all 0 without words."""
    words = (text or b"").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    decoded = text.decode("utf-8", "replace")
    lines = [x for x in text.split(b"\n") if x.strip()]
    count = Counter(words)
    chars = sum(map(len, words))
    letters = len(text.translate(None, _LETTERS))
    capitals = len(_UPPER.findall(decoded))
    return [
        float(np.log1p(n)),
        min(chars / n, 30.0),
        min(len(text.translate(None, _SYMBOLS)) / n, 3.0),
        capitals / max(letters, 1),
        len(text.translate(None, _KEEP_DIGITS)) / chars,
        min(text.count(b"!") / n, 3.0),
        min(text.count(b",") / n, 1.0),
        min(text.count(b".") / n, 1.0),
        min(text.count(b"|") / n, 1.0),
        1 - len(set(lines)) / len(lines),
        len(count) / n**0.9,
        count.most_common(1)[0][1] / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        float(np.log1p(n / len(lines))),
        1 - letters / max(len(text) - n, 1),
        min(capitals / n, 10.0),
        sum(len(w) > 16 for w in words) / n,
        1.0,
    ]


def _features(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return {"x": pa.array([features(t) for t in texts_of(batch)], pa.list_(pa.float64()))}


class Ranker:
    """A learned scorer: standardization, weights and threshold."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut, -500, 500)))


def indifferent() -> Ranker:
    """Scores everything 0.5: nothing to learn from."""
    k = len(FEATURES)
    return Ranker(np.zeros(k), np.ones(k), np.zeros(k), 0.0)


def threshold(scores: np.ndarray, labels: np.ndarray, steps: int = 400) -> float:
    """The quantile of ``scores`` at which more of the labels agree than at any other."""
    cuts = np.unique(np.quantile(scores, np.linspace(0, 1, steps + 1)))
    right = [((scores >= c) == (labels == 1)).mean() for c in cuts]
    best = int(np.argmax(right))
    below = scores[scores < cuts[best]]
    return float((cuts[best] + below.max()) / 2) if len(below) else float(cuts[best] - 1e-6)


def fit_ranker(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    pairs: int = PAIRS,
) -> Ranker:
    """Learn from the documents that ``labels`` (id, label 0 or 1) names, ``sample`` at most.

    Null ids and labels teach nothing, repeated labels count once; without
    documents of both labels every score is 0.5.
    """
    named = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    named = named.where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).distinct()
    chosen = named.orderBy(F.xxhash64(F.col("id").cast("string")), "id", "y").limit(sample)
    chosen = materialize(chosen, "chosen")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias(TEXT))
    known = texts.join(F.broadcast(chosen), "id")  # at most ``sample`` ids
    rows = add_columns(known, _features, [field("x", T.ArrayType(T.DoubleType()))], keep=("id", "y"))
    rows = rows.orderBy(F.xxhash64(F.col("id").cast("string"), F.lit(1)), "id").limit(sample)
    rows = rows.withColumn("i", F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id"), "id")) - 1)
    rows = materialize(rows, "examples")
    count = {r.y: r.n for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return indifferent()
    many, few = (1, 0) if count[1] >= count[0] else (0, 1)
    stats = rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("scale")
    )
    stats = sorted(stats.collect(), key=lambda r: r["at"])
    mean = np.array([r["mean"] for r in stats])
    scale = np.array([r["scale"] if r["scale"] > 1e-9 else 1.0 for r in stats])
    values = [
        F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col("x")[k] - float(mean[k])) / float(scale[k])))
        for k in range(len(FEATURES))
    ]
    rows = rows.select("y", "i", F.array(*values).alias("x"))
    left = rows.where(F.col("y") == many).select("i", F.col("x").alias("xa"))
    left = left.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(pairs - 1))))
    left = left.withColumn("j", ((F.col("i") * pairs + F.col("k")) % count[few]).cast("int"))
    right = rows.where(F.col("y") == few).select(F.col("i").alias("j"), F.col("x").alias("xb"))
    sign = F.when(F.col("k") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    against = left.join(right, "j").select(
        array_to_vector(F.zip_with("xa", "xb", lambda a, b: (a - b) * sign)).alias("features"),
        # The difference is preferred minus other if the larger class is 1 and the sign +.
        F.when((F.col("k") % 2 == 0) == F.lit(many == 1), F.lit(1.0)).otherwise(F.lit(0.0)).alias("label"),
    )
    against = materialize(against, "pairs")
    model = LogisticRegression(
        fitIntercept=False, standardization=False, regParam=STRENGTH, maxIter=60, tol=1e-7
    ).fit(against)
    ranker = Ranker(mean, scale, np.array(model.coefficients.toArray()), 0.0)
    seen = rows.select("y", "x").collect()  # at most ``sample`` rows
    raw = np.array([r.x for r in seen]) @ ranker.weights
    ranker.cut = threshold(raw, np.array([r.y for r in seen]))
    return ranker


def score_documents(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """``__row``, score and predicted (1 if score >= 0.5) of every document.

    Null and empty texts are scored as texts without words, equal texts equally;
    very long texts are measured whole; an empty table gives no rows; other columns
    stay inside ``__row``, whatever their names.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(ranker)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        x = np.array([features(t) for t in texts_of(batch)]).reshape(-1, len(FEATURES))
        score = shipped.value.score(x)
        return {
            "score": pa.array(score, pa.float64()),
            "predicted": pa.array((score >= 0.5).astype(np.int32), pa.int32()),
        }

    fields = [field("score", T.DoubleType()), field("predicted", T.IntegerType())]
    return add_columns(with_row(docs, text_col), compute, fields)


def held_out(doc_id: str | Column) -> Column:
    return id_crc(doc_id) % 3 == 1


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; learned where crc32(doc_id) mod 3 is not 1."""
    ranker = fit_ranker(docs, labels.where(~held_out("doc_id")))
    return score_documents(docs.select("doc_id", "text"), ranker).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        held_out(F.col(f"{ROW}.doc_id")).alias("held_out"),
        "score",
        "predicted",
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that are predicted 1."""
    ranker = fit_ranker(docs, labels)
    return score_documents(docs, ranker).where(F.col("predicted") == 1).select(f"{ROW}.*")
