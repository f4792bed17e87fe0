"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Symbols are words (``common.plain_words``). Every run of ``window``
consecutive words of a benchmark item is a test string; an item with fewer
words, but not none, is one test string. Test strings of one length share a
block shift table: the last ``BLOCK`` words under the cursor either lie in no
test string (skip ahead as far as possible), end at a known distance before a
test string's end (skip that far), or are the suffix of some (shift 0). Then
the bucket of that suffix hash gives the candidates, whose first words and
then all words are compared directly.

Scale: the benchmark is cut into blocks of distinct items of a bounded number
of bytes; only one block at a time is brought to the driver and shipped to the
tasks. The documents are scanned once per block in a narrow stage without
any shuffle. With several blocks the documents are written once, with a number
for each row; each block reads only numbers and texts and writes only hits,
which are joined to the documents at the end.
"""

from __future__ import annotations

import uuid
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import (
    ROW,
    TEXT,
    add_columns,
    field,
    materialize,
    plain_words,
    texts_of,
    with_row,
)

WINDOW = 10
BLOCK = 3
BLOCK_BYTES = 2 << 20
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


class TestStrings:
    """The shift tables and suffix buckets of one block of benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW, block: int = BLOCK):
        self.ids: dict[bytes, int] = {}
        self.names: list[str] = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        strings: dict[int, dict[tuple, set[int]]] = {}
        for name, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in plain_words(text)]
            length = min(window, len(words))
            for k in range(len(words) - length + 1 if words else 0):
                found = strings.setdefault(length, {}).setdefault(tuple(words[k : k + length]), set())
                found.add(number[name])
        self.lengths = [self._tables(n, found, min(block, n)) for n, found in sorted(strings.items())]

    @staticmethod
    def _keys(words: np.ndarray, block: int) -> list[int]:
        """Hash of each block of words, by its first position."""
        n = len(words) - block + 1
        key = np.zeros(max(n, 0), dtype=np.uint64)
        for j in range(block):
            key += words[j : j + n].astype(np.uint64) * MIX[j]
        return key.tolist()

    def _tables(self, length: int, strings: dict[tuple, set[int]], block: int) -> tuple:
        shift: dict[int, int] = {}
        buckets: dict[int, list[tuple]] = {}
        far = length - block
        for string, items in strings.items():
            keys = self._keys(np.array(string), block)
            for j, key in enumerate(keys):
                if far - j < shift.get(key, far + 1):
                    shift[key] = far - j
            buckets.setdefault(keys[-1], []).append((string[0], list(string), items))
        return length, block, far + 1, shift, buckets

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """The (start, end) word positions of all occurrences, and the items they are of."""
        row = list(map(self.ids.get, words, repeat(0)))
        spans, items = [], set()
        n = len(row)
        if not any(row):
            return spans, items
        array = np.array(row, dtype=np.int64)
        for length, block, most, shift, buckets in self.lengths:
            if n < length:
                break
            keys = self._keys(array, block)
            at, last, step = length - block, n - block, shift.get
            while at <= last:
                skip = step(keys[at], most)
                if skip:
                    at += skip
                    continue
                start = at + block - length
                for first, string, of in buckets[keys[at]]:
                    if row[start] == first and row[start : start + length] == string:
                        spans.append((start, start + length))
                        items |= of
                        break  # strings of one length differ, so no other one is here
                at += 1
        return spans, items


_TABLES: dict[str, TestStrings] = {}


def _hits(spans: np.ndarray, n_words: int) -> int:
    """The words that the (start, end) rows of ``spans`` cover."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 1], -1)
    return int((np.cumsum(edge) > 0).sum())


FOUND = [
    field("n_words", T.LongType()),
    field("n_hit", T.LongType()),
    field("spans", T.BinaryType()),
    field("items", T.ArrayType(T.StringType())),
]


def _found(rows: list[tuple]) -> dict[str, pa.Array]:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()))
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return {f.name: pa.array(c, t) for f, c, t in zip(FOUND, columns, kinds, strict=True)}


def _scan(df: DataFrame, items: list[tuple[str, bytes]], window: int, keep: str) -> DataFrame:
    """``keep`` and the ``FOUND`` columns of each text for one block of items."""
    shipped = df.sparkSession.sparkContext.broadcast(items)
    name = uuid.uuid4().hex

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        if name not in _TABLES:
            _TABLES.clear()
            _TABLES[name] = TestStrings(shipped.value, window)
        tables, out = _TABLES[name], []
        for text in texts_of(batch):
            words = plain_words(text)
            places, of = tables.search(words)
            spans = np.array(places, dtype="<i4").reshape(-1, 2)
            n_hit = _hits(spans, len(words)) if places else 0
            out.append((len(words), n_hit, spans.tobytes(), sorted(tables.names[k] for k in of)))
        return _found(out)

    return add_columns(df, compute, FOUND, keep=(keep,))


def _combined(df: DataFrame) -> DataFrame:
    """``__row`` and the ``FOUND`` columns of rows with the ``parts`` that the blocks found in each text."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out = []
        for text, parts in zip(texts_of(batch), texts_of(batch, "parts"), strict=True):
            n_words, parts = len(plain_words(text)), parts or []
            spans = b"".join(p["spans"] for p in parts)
            n_hit = _hits(np.frombuffer(spans, dtype="<i4").reshape(-1, 2), n_words) if spans else 0
            out.append((n_words, n_hit, spans, sorted({i for p in parts for i in p["items"]})))
        return _found(out)

    return add_columns(df, compute, FOUND)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document row: ``__row`` (the row), n_words, n_hit, spans, items.

    ``spans`` holds (start, end) word positions of the occurrences as pairs
    of little-endian 32-bit integers, ``items`` the sorted distinct item ids
    (as text) with occurring test strings. ``block_bytes`` bounds the
    benchmark text in memory at a time (one item is never cut).

    Null and empty texts have no words and no hits; items without words test
    nothing; a null item id is the id ``null``; items that repeat count
    once; repeated documents are judged each; an empty benchmark hits nothing; an
    empty table gives no rows. Very long texts are searched whole; other columns
    stay inside ``__row``, whatever their names.
    """
    # Distinct first: equal rows would share a block, whatever its bytes. The block of an item
    # depends on its text and the total, which grows with the benchmark alone.
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"),
        F.col(f"`{item_text_col}`").cast("binary").alias("text"),
    ).where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("text", "item"), F.lit(blocks)))
    if blocks > 1:
        items = materialize(items.repartition("block"), "benchmark")

    def block(k: int) -> list[tuple[str, bytes]]:
        return [(r.item, bytes(r.text)) for r in items.where(F.col("block") == k).collect()]

    rows = with_row(docs, text_col)
    if blocks == 1:
        return _scan(rows, block(0), window, keep=ROW)
    rows = materialize(rows.withColumn("rid", F.monotonically_increasing_id()), "documents")
    texts = rows.select("rid", TEXT)
    hits = None
    for k in range(blocks):
        found = _scan(texts, block(k), window, keep="rid").where("n_hit > 0")
        found = materialize(found.select("rid", F.struct("spans", "items").alias("part")), "hits")
        hits = found if hits is None else hits.union(found)
    parts = hits.groupBy("rid").agg(F.collect_list("part").alias("parts"))
    return _combined(rows.join(parts, "rid", "left"))


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each document."""
    found = find_contamination(docs, benchmark)
    return found.select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without those that hold any test string."""
    return find_contamination(docs, benchmark).where(F.col("n_hit") == 0).select(f"{ROW}.*")
