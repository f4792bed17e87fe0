"""Importance resampling of documents towards a target distribution.

Features are runs of one and two consecutive words, hashed into ``BUCKETS`` by the
CRC-32 of their bytes. The words of a slice of texts are the entries of an
Aho-Corasick automaton, each between two delimiters; its payload is the CRC of the
word, the CRC of the word and a space, and its length. A scan of the texts emits the
payloads of their words in order, and the CRC of two adjacent words follows from
theirs alone: a CRC register moved over the second word's length (a linear map
of bits, by tables for lengths that are powers of two), xor the second CRC. No
feature is ever written out.

A bucket's gain is the log ratio of its smoothed shares in the target and in the
documents, a document's weight the mean gain of its features, and its score the weight
with Gumbel noise, so that the highest scores are a sample without replacement in
proportion to exp(weight).

Scale: both tables are scanned twice in narrow stages (once for the documents' counts,
once for their scores); a task sends on one count a bucket. An automaton has
at most ``ENTRIES`` words; a slice with more is scanned once for each block of them.
Ranks come from range partitions of (score, id), not from one sorted task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import ROW, TEXT, add_columns, field, materialize, plain_words, small, texts_of, with_row

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
#: Percent of the eligible documents that are drawn.
PERCENT = 25
#: Words of one automaton.
ENTRIES = 1 << 16
#: Texts scanned together: few enough words for one automaton that stays in the processor's cache.
SLICE_BYTES = 1 << 19
_POLYNOMIAL = 0xEDB88320  # CRC-32, bits reversed


def _tables(columns: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by the images of the bits, as a table for each byte."""
    out = np.zeros((4, 256), dtype=np.uint32)
    for byte in range(4):
        for bit in range(8):
            step = 1 << bit
            out[byte, step : 2 * step] = out[byte, :step] ^ columns[8 * byte + bit]
    return out


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[0][crc & np.uint32(255)]
    for byte in range(1, 4):
        out = out ^ tables[byte][(crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


class Shift:
    """Moves CRC registers over so many bytes."""

    def __init__(self) -> None:
        image = np.uint32(1) << np.arange(32, dtype=np.uint32)
        for _ in range(8):
            odd = (image & np.uint32(1)).astype(bool)
            image = (image >> np.uint32(1)) ^ np.where(odd, np.uint32(_POLYNOMIAL), np.uint32(0))
        self.powers = [_tables(image)]

    def __call__(self, crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        crc, power = crc.copy(), 0
        while (lengths >> power).any():
            if power == len(self.powers):
                bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
                half = self.powers[-1]
                self.powers.append(_tables(_apply(half, _apply(half, bits))))
            on = (lengths >> power & 1).astype(bool)
            crc[on] = _apply(self.powers[power], crc[on])
            power += 1
        return crc


_SHIFT = Shift()


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs of strings put together, from their CRCs and the lengths of the second ones."""
    return _SHIFT(first, length) ^ second


def scan(text: str, words: list[str]) -> np.ndarray:
    """The indices into ``words`` of the words in ``text``, in order, where all words stand between single spaces."""
    ends, found = [], []
    for start in range(0, len(words), ENTRIES):
        automaton = ahocorasick.Automaton()
        for k in range(start, min(start + ENTRIES, len(words))):
            automaton.add_word(f" {words[k]} ", k)
        automaton.make_automaton()
        if len(words) <= ENTRIES:  # the payloads come in the order of the text
            return np.fromiter(map(itemgetter(1), automaton.iter(text)), dtype=np.int64)
        hits = np.fromiter(chain.from_iterable(automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
        ends.append(hits[:, 0])
        found.append(hits[:, 1])
    return np.concatenate(found)[np.argsort(np.concatenate(ends))]


def feature_buckets(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of all features of all texts, and the words of each text."""
    plain = [plain_words(t) for t in texts]
    counts = np.array([len(p) for p in plain], dtype=np.int64)
    if not counts.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    raw = list(set().union(*plain))
    words = [w.decode("latin-1") for w in raw]
    joined = b" ".join([b" ".join(p) for p in plain if p]).decode("latin-1")
    crc = np.array([zlib.crc32(w) for w in raw], dtype=np.uint32)
    spaced = np.array([zlib.crc32(b" ", c) for c in crc.tolist()], dtype=np.uint32)
    length = np.array([len(w) for w in raw], dtype=np.int64)
    at = scan(f" {joined} ", words)
    text = np.repeat(np.arange(len(texts)), counts)
    inside = text[1:] == text[:-1]
    first, second = at[:-1][inside], at[1:][inside]
    pairs = joined_crc(spaced[first], crc[second], length[second])
    bucket = np.concatenate([crc[at], pairs]).astype(np.int64) % buckets
    return np.concatenate([text, text[1:][inside]]), bucket, counts


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): the features of all texts in each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in small(batch, SLICE_BYTES):
                total += np.bincount(feature_buckets(texts_of(part), buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["bucket", "n"])

    texts = docs.select(F.col(f"`{text_col}`").cast("binary").alias(TEXT))
    parts = texts.mapInArrow(run, "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    docs: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS
) -> np.ndarray:
    """The gain of each bucket: 1000 times the log ratio of its smoothed shares, rounded down."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, table in ((s, docs), (t, target)):
        for row in bucket_counts(table, text_col, buckets).collect():  # a row for each bucket at most
            counts[row["bucket"]] = row["n"]
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def noise(doc_id: str | Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel variable that belongs to the id, rounded down; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def score_documents(
    docs: DataFrame,
    gains: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """``__row`` (the ``keep`` columns; default all), n_words, n_features, weight and score of every document.

    Null and empty texts have no words, no features and weight 0.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(gains)  # one number a bucket

    def weigh(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, bucket, words = feature_buckets(texts, len(shipped.value))
        n = np.bincount(at, minlength=len(texts))
        order = np.argsort(at, kind="stable")
        runs = np.concatenate([[0], np.cumsum(shipped.value[bucket[order]])])
        ends = np.cumsum(n)
        sums = runs[ends] - runs[ends - n]
        return words, n, np.where(n > 0, sums // np.maximum(n, 1), 0)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        parts = [weigh(texts_of(part)) for part in small(batch, SLICE_BYTES)]
        names = ("n_words", "n_features", "weight")
        return {
            k: pa.array(np.concatenate(v), pa.int64()) if parts else pa.array([], pa.int64())
            for k, v in zip(names, zip(*parts, strict=True) if parts else ((),) * 3, strict=True)
        }

    rows = with_row(docs, text_col)
    if keep is not None:
        rows = rows.select(F.struct(*[F.col(f"{ROW}.`{c}`") for c in keep]).alias(ROW), TEXT, F.col(f"{ROW}.`{id_col}`").alias("id"))
    else:
        rows = rows.withColumn("id", F.col(f"{ROW}.`{id_col}`"))
    fields = [field(k, T.LongType()) for k in ("n_words", "n_features", "weight")]
    scored = add_columns(rows, compute, fields, keep=(ROW, "id"))
    return scored.withColumn("score", F.col("weight") + noise("id", seed))


def ranked(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... of the drawn documents by falling score, ties by rising id; else null.

    Null ids come last among equal scores; rows equal in score and id are told apart by nothing.
    """
    held = materialize(scored.withColumn("rid", F.monotonically_increasing_id()), "scored")
    may = F.col("n_words") >= least_words
    quota = held.where(may).count() * percent // 100
    # ``rid`` lets a range boundary fall between rows that are equal in score and id.
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("rid")]
    drawn = held.where(may).repartitionByRange(*order).sortWithinPartitions(*order)
    drawn = materialize(drawn.withColumn("place", F.monotonically_increasing_id()), "ordered")
    drawn = drawn.withColumn("part", F.shiftright("place", 33))
    counts = drawn.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("place") - F.shiftleft(F.col("part"), 33) + 1
    drawn = drawn.join(offsets, "part").withColumn("rank", F.when(place <= quota, place))
    rest = held.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*rest.columns).unionByName(rest).drop("rid")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    seed: int = SEED,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """``__row`` (the ``keep`` columns; default all), n_words, n_features, weight, score and rank of every document.

    Words are those of ``common.plain_words``; null and empty texts have none. Very long texts are
    scanned whole. Documents of fewer than ``least_words`` words are never drawn. Rows that
    repeat are documents of their own, with equal scores; ties go to the smaller id. Empty tables:
    no documents give no rows, an empty target makes every gain depend on the documents alone.
    """
    gains = bucket_gains(docs, target, text_col, buckets)
    scored = score_documents(docs, gains, id_col, text_col, seed, keep)
    return ranked(scored, least_words, percent)


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, all their columns."""
    return resample(docs, target, **options).where("rank IS NOT NULL").select(f"{ROW}.*")


def resample_report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    return resample(docs, target, keep=("doc_id",)).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank"
    )
