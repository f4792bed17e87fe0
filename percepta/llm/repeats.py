"""Removal of repeated passages with enhanced suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else, in this or any other text.

1. Anchors. Each window of LENGTH bytes picks the 64-byte gram of least hash
   inside it (leftmost among equals), so equal windows pick equal anchors at
   equal offsets. Neighbouring windows with the same anchor form one
   occurrence: the anchor, the first and last window start, and a hash of the
   bytes between them (its context). Anchors found once are done with.
2. Equal contexts of an anchor need no comparison: all of their windows
   repeat. One of them stands for all in what follows.
3. The different contexts of the anchors go through a suffix array in blocks
   of whole anchors, but for those that differ from all others near the anchor
   (``sieve``): suffixes sorted by tripling, common prefixes of
   neighbours, a stack scan of the tree of common-prefix intervals, and of
   each interval with at least two different bytes to the left (or a
   context's start) all occurrences: the maximal repeat groups.
4. An anchor with too many different contexts for one block is split by
   window starts, ever finer, each part under a key made of the bytes that
   all its windows have in common; a part of one start has equal windows
   alone, which step 2 decides. Nothing is capped.

Scale: rows are anchors (about one for 170 bytes); texts are shuffled only
to fetch the bytes of step 3 and to cut the result. All joins are by hashes;
copies are combined before the shuffle, and hot keys are left to the adaptive
skew join.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import (
    ROW,
    TEXT,
    add_columns,
    field,
    materialize,
    small,
    text_key,
    texts_of,
    with_row,
)

LENGTH = 400
GRAM = 64
#: A passage that repeats: a run of so many words ...
PASSAGE_WORDS = 50
#: ... that strings of so many bytes cover: fifty words of two bytes and a space. Anchors are shorter, as the windows are.
PASSAGE_BYTES, PASSAGE_GRAM = 150, 32
#: Most context bytes of one anchor that one suffix array takes.
GROUP_BYTES = 4 << 20
#: Bytes after which a suffix array is closed at the next anchor.
BLOCK_BYTES = 1 << 20
SLICE_BYTES = 1 << 20
#: Strings around an anchor, one of which equal windows have in common.
STRINGS = 8
#: Window starts in one part of an anchor that is too large, level by level.
PARTS = (48, 6, 1)
_PLACE = (1 << 30) - 1
_BYTE = np.random.Generator(np.random.Philox(key=[5, 64])).integers(
    0, 1 << 64, 256, dtype=np.uint64
)
_BASE = 0x9E3779B97F4A7C15

#: Equal contexts of one text share a row: the anchor lies ``off`` behind each start in ``los``,
#: the last window starts ``span`` behind it.
OCCURRENCE = "key long, ctx long, tkey binary, off int, span int, los array<int>"


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of the ``gram`` bytes (a power of two) from each position."""
    h, size = _BYTE[data], 1
    while size < gram:
        h = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + h[size:]
        size *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(text, a, lo, hi, hash) of all occurrences in texts that lie end to end in ``data``."""
    width = length - gram + 1  # grams in a window
    starts = np.concatenate([[0], ends[:-1]])
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    hashes = gram_hashes(data, gram)
    least = (hashes & np.uint64(~_PLACE & (1 << 64) - 1)) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        rest = width - size
        least = np.minimum(least[: len(least) - rest], least[rest:])
    pick = (least & np.uint64(_PLACE)).astype(np.int64)
    text = np.repeat(np.arange(len(ends)), ends - starts)[: len(pick)]
    at = np.flatnonzero(np.arange(len(pick)) + length <= ends[text])
    if not len(at):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    first = np.ones(len(at), dtype=bool)
    first[1:] = (pick[at[1:]] != pick[at[:-1]]) | (text[at[1:]] != text[at[:-1]])
    lo = at[first]
    hi = at[np.append(np.flatnonzero(first)[1:], len(at)) - 1]
    return text[lo], pick[lo], lo, hi, hashes[pick[lo]]


def _signed(values) -> np.ndarray:
    return np.asarray(values, dtype=np.uint64).view(np.int64)


def _rows(found: list[tuple], most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Batches of occurrences (key, ctx, tkey, off, span, los)."""
    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
    for k in range(0, len(found), most):
        key, ctx, *rest = zip(*found[k : k + most], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_signed(key)), pa.array(_signed(ctx))]
            + [pa.array(v, t) for v, t in zip(rest, kinds, strict=True)],
            names=["key", "ctx", "tkey", "off", "span", "los"],
        )


def _first_level(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small(batch, SLICE_BYTES):
                texts = [t or b"" for t in texts_of(part)]
                joined = b"".join(texts)
                sizes = np.array([len(t) for t in texts], dtype=np.int64)
                ends = np.cumsum(sizes)
                text, a, lo, hi, key = anchors(np.frombuffer(joined, dtype=np.uint8), ends, length, gram)
                if not len(lo):
                    continue
                view = memoryview(joined)
                places = zip(lo.tolist(), (hi + length).tolist(), (a - lo).tolist(), strict=True)
                ctx = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e], off) for s, e, off in places), np.uint64, len(lo))
                order = np.lexsort((lo, ctx, key, text))
                names = [c[order] for c in (text, key, ctx, a - lo, hi - lo)]
                first = np.ones(len(order), dtype=bool)
                first[1:] = np.any([c[1:] != c[:-1] for c in names], axis=0)
                begin = np.flatnonzero(first)
                text, key, ctx, off, span = (c[begin] for c in names)
                los = pa.array(lo[order] - (ends - sizes)[names[0]], pa.int32())
                rows = pa.RecordBatch.from_arrays(
                    [
                        pa.array(_signed(key)),
                        pa.array(_signed(ctx)),
                        part.column(part.schema.get_field_index("tkey")).take(pa.array(text)),
                        pa.array(off, pa.int32()),
                        pa.array(span, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(np.append(begin, len(order)), pa.int32()), los),
                    ],
                    names=["key", "ctx", "tkey", "off", "span", "los"],
                )
                for k in range(0, rows.num_rows, 50_000):
                    yield rows.slice(k, 50_000)

    return run


def _finer_level(length: int, gram: int, step: int):
    """Occurrences (``places`` of each text) cut into parts of ``step`` window starts."""
    reach = length - gram

    def cut(view: memoryview, place: dict) -> Iterator[tuple]:
        key = (place["key"] & (1 << 64) - 1).to_bytes(8, "little")
        for start in place["los"]:
            zero = start + place["off"] - reach
            for b in range((start - zero) // step, (start + place["span"] - zero) // step + 1):
                x = zero + b * step
                lo, hi = max(start, x), min(start + place["span"], x + step - 1)
                common = xxhash.xxh3_64_intdigest(view[x + step - 1 : x + length], b)
                new = xxhash.xxh3_64_intdigest(common.to_bytes(8, "little") + key)
                off = start + place["off"] - lo
                yield new, xxhash.xxh3_64_intdigest(view[lo : hi + length], off), off, hi - lo, lo

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small(batch, SLICE_BYTES):
                rows = []
                for text, tkey, places in zip(
                    texts_of(part), texts_of(part, "tkey"), texts_of(part, "places"), strict=True
                ):
                    found: dict[tuple, list[int]] = {}
                    for place in places:
                        for *name, lo in cut(memoryview(text), place):
                            found.setdefault(tuple(name), []).append(lo)
                    rows += [(k, c, tkey, o, n, v) for (k, c, o, n), v in found.items()]
                yield from _rows(rows)

    return run


class SuffixArray:
    """Suffixes of blocks that lie end to end; no suffix reaches into the next block."""

    WIDTH = 7  # symbols of 9 bits in the first key

    def __init__(self, data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int):
        """``starts``: the positions whose suffixes are wanted, all with ``length`` bytes at least."""
        n = len(data)
        sizes = np.diff(np.concatenate([[0], ends]))
        self.data, self.length = data, length
        self.end = np.repeat(ends, sizes)
        longest = int(sizes.max())
        padded = np.concatenate([data.astype(np.int64) + 1, np.zeros(self.WIDTH, np.int64)])
        place = np.arange(n)
        key = np.zeros(n, dtype=np.int64)
        for j in range(self.WIDTH):
            key = key << 9 | np.where(place + j < self.end, padded[j : j + n], 0)
        # Three ranks fit a key of 64 bits but in very large blocks.
        self.times = 3 if n + 1 < 1 << 21 else 2
        self.size, self.ranks = self.WIDTH, []
        while True:
            rank = np.unique(key, return_inverse=True)[1].ravel().astype(np.int64)
            self.ranks.append((self.size, rank.astype(np.int32)))
            # Only the wanted suffixes are sorted by the last key.
            last = self.size * self.times >= longest
            at = starts if last else place
            key = rank[at]
            for j in range(1, self.times):
                next_at = at + j * self.size
                inside = next_at < self.end[at]
                behind = np.zeros(len(at), dtype=np.int64)
                behind[inside] = rank[next_at[inside]] + 1
                key = key * (n + 1) + behind
            if last:
                break
            self.size *= self.times
        self.order = starts[np.argsort(key, kind="stable")]
        self.common = self._common(self.order[:-1], self.order[1:])

    def _common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes that the suffixes at x and y have in common."""
        most = np.minimum(self.end[x] - x, self.end[y] - y)
        got = np.zeros(len(x), dtype=np.int64)
        for size, rank in reversed(self.ranks):
            for _ in range(self.times):
                go = got + size <= most
                go[go] = rank[x[go] + got[go]] == rank[y[go] + got[go]]
                got[go] += size
        for _ in range(self.WIDTH):
            go = got < most
            go[go] = self.data[x[go] + got[go]] == self.data[y[go] + got[go]]
            got[go] += 1
        return got

    def maximal_repeats(self, left: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(length, all start positions) of each maximal repeat of ``length`` bytes or more.

        ``left``: the byte before each position, a different negative number at a block's start.
        """
        deep = np.concatenate([[0], np.where(self.common >= self.length, self.common, 0), [0]])
        before = left[self.order]
        for start in np.flatnonzero((deep[:-1] == 0) & (deep[1:] > 0)).tolist():
            # [depth, first entry, byte to the left of all entries or None]
            stack = [[0, start, None]]
            k = start
            byte = int(before[k])
            while True:
                k += 1
                depth = int(deep[k])
                begin = k - 1
                while stack[-1][0] > depth:
                    found, begin, seen = stack.pop()
                    seen = byte if seen == byte else None
                    if seen is None:
                        yield found, self.order[begin:k]
                    byte = seen
                if depth == 0:
                    break
                if stack[-1][0] < depth:
                    stack.append([depth, begin, byte])
                elif stack[-1][2] != byte:
                    stack[-1][2] = None
                byte = int(before[k])


def repeated_spans(
    contexts: list[bytes], length: int = LENGTH
) -> list[list[tuple[int, int]]]:
    """The parts of each context that repeats of ``length`` bytes or more among them cover."""
    joined = b"".join(contexts)
    ends = np.cumsum([len(c) for c in contexts])
    begins = ends - [len(c) for c in contexts]
    data = np.frombuffer(joined, dtype=np.uint8)
    starts = np.concatenate([np.arange(b, e - length + 1) for b, e in zip(begins, ends, strict=True)])
    tree = SuffixArray(data, ends, starts, length)
    left = np.empty(len(data), dtype=np.int64)
    left[1:] = data[:-1]
    left[begins] = -1 - np.arange(len(begins))
    cover = np.zeros(len(data), dtype=np.int64)
    for size, places in tree.maximal_repeats(left):
        np.maximum.at(cover, places, size)
    edge = np.zeros(len(data) + 1, dtype=np.int64)
    hit = np.flatnonzero(cover)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + cover[hit], -1)
    covered = np.cumsum(edge)[:-1] > 0
    out = []
    for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
        step = np.diff(np.concatenate([[0], covered[b:e].astype(np.int8), [0]]))
        out.append(list(zip(np.flatnonzero(step > 0).tolist(), np.flatnonzero(step < 0).tolist(), strict=True)))
    return out


def sieve(rows: list[tuple], length: int, gram: int) -> list[tuple]:
    """Those of an anchor's rows (key, ctx, data, off) that may have a window in common.

    A window has ``length - gram`` bytes beside the anchor. Cut into STRINGS parts, at least i of
    them lie before it and the others but one behind, for some i: equal windows have an equal string.
    """
    step = (length - gram) // STRINGS
    around = []
    for _, _, data, off in rows:
        view = memoryview(data)
        strings = ((i, off - i * step, off + gram + (STRINGS - 1 - i) * step) for i in range(STRINGS))
        around.append([xxhash.xxh3_64_intdigest(view[s:e], i) for i, s, e in strings if s >= 0 and e <= len(data)])
    seen = Counter(h for hashes in around for h in hashes)
    return [row for row, hashes in zip(rows, around, strict=True) if any(seen[h] > 1 for h in hashes)]


def _compare(length: int, gram: int, block_bytes: int):
    """Rows (key, ctx, data, off) sorted by key, to repeated parts (key, ctx, s, e) of the contexts."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        spans = repeated_spans([r[2] for r in rows], length)
        out = [(key, ctx, s, e) for (key, ctx, *_), found in zip(rows, spans, strict=True) for s, e in found]
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["key", "ctx", "s", "e"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        group: list[tuple] = []  # of the same anchor
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if group and group[-1][0] != row[0]:
                    near = sieve(group, length, gram)
                    rows += near
                    held += sum(len(r[2]) for r in near)
                    group = []
                    if held >= block_bytes:
                        yield from solve(rows)
                        rows, held = [], 0
                group.append(row)
        rows += sieve(group, length, gram)
        if rows:
            yield from solve(rows)

    return run


def _contexts(length: int, *more: str):
    """The bytes of the ``places`` of each text, and ``more`` numbers of the place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small(batch, SLICE_BYTES):
                rows = [
                    (p["key"], p["ctx"], text[p["lo"] : p["lo"] + p["span"] + length], *(p[m] for m in more))
                    for text, places in zip(texts_of(part), texts_of(part, "places"), strict=True)
                    for p in places
                ]
                for k in range(0, len(rows), 4000):
                    key, ctx, data, *rest = zip(*rows[k : k + 4000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key, pa.int64()), pa.array(ctx, pa.int64()), pa.array(data, pa.binary())]
                        + [pa.array(v, pa.int32()) for v in rest],
                        names=["key", "ctx", "data", *more],
                    )

    return run


def repeated(
    texts: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    group_bytes: int = GROUP_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(tkey, spans): the repeated parts of each text of (tkey, ``__text``) that has any.

    A span (los, s, e) is the bytes from s to e behind each start in ``los``.
    Rows with equal keys must have equal texts; each row counts as a text.
    """
    spans = []
    # Step 2 has all windows of a text with copies: later steps need it once, as a partner.
    once = texts.groupBy("tkey").agg(F.first(TEXT).alias(TEXT))
    many = F.sum(F.size("los"))
    whole = [F.lit(0).alias("s"), (F.col("span") + length).alias("e")]
    rows = texts.mapInArrow(_first_level(length, gram), OCCURRENCE)
    for step in (*PARTS, None):
        found = materialize(rows, "anchors")
        shared = found.groupBy("key").agg(many.alias("n"), F.min("ctx").alias("least"), F.max("ctx").alias("most"))
        shared = shared.where("n > 1").select("key", (F.col("least") != F.col("most")).alias("differ"))
        shared = materialize(shared, "keys")  # a plain table: the join can split a hot key
        found = materialize(found.join(shared, "key"), "shared")
        spans.append(found.where("not differ").select("tkey", "los", *whole))
        found = found.where("differ")
        one = F.min(F.struct("tkey", "off", "span", F.col("los")[0].alias("lo")))
        kinds = materialize(found.groupBy("key", "ctx").agg(many.alias("n"), one.alias("one")), "contexts")
        size = F.sum(F.col("one.span") + length)
        hot = kinds.groupBy("key").agg(size.alias("size")).where(F.col("size") > group_bytes)
        hot = materialize(hot.select("key"), "hot")
        twice = kinds.where("n > 1").select("key", "ctx")
        spans.append(found.join(twice, ["key", "ctx"]).select("tkey", "los", *whole))
        if step is None:
            break
        places = (
            kinds.join(hot, "key", "left_anti")
            .select("key", "ctx", "one.*")
            .groupBy("tkey")
            .agg(F.collect_list(F.struct("key", "ctx", "off", "span", "lo")).alias("places"))
        )
        flags = (
            once.join(places, "tkey")
            .select(TEXT, "places")
            .mapInArrow(_contexts(length, "off"), "key long, ctx long, data binary, off int")
            .repartition("key")
            .sortWithinPartitions("key", "ctx")
            .mapInArrow(_compare(length, gram, block_bytes), "key long, ctx long, s int, e int")
        )
        spans.append(found.join(materialize(flags, "flags"), ["key", "ctx"]).select("tkey", "los", "s", "e"))
        if hot.isEmpty():
            break
        places = (
            found.join(hot, "key", "left_semi")
            .groupBy("tkey")
            .agg(F.collect_set(F.struct("key", "off", "span", "los")).alias("places"))
        )
        rows = once.join(places, "tkey").select(TEXT, "tkey", "places")
        rows = rows.mapInArrow(_finer_level(length, gram, step), OCCURRENCE)
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    return materialize(every.groupBy("tkey").agg(F.collect_set(F.struct("los", "s", "e")).alias("spans")), "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Spans (los, s, e) as sorted (start, end) that neither overlap nor touch."""
    out: list[list[int]] = []
    for s, e in sorted((lo + x["s"], lo + x["e"]) for x in spans or () for lo in x["los"]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tkey, spans) to (tkey, runs): the spans as sorted (s, e) that neither overlap nor touch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        spans = batch.column(batch.schema.get_field_index("spans"))
        parts = spans.flatten()
        los = parts.field("los")
        size = spans.value_lengths().to_numpy(zero_copy_only=False)
        part = np.repeat(np.arange(len(parts)), los.value_lengths().to_numpy(zero_copy_only=False))
        # The text in the upper half, the byte in the lower one.
        zero = (np.repeat(np.arange(batch.num_rows), size)[part] << 32) + los.flatten().to_numpy()
        start = zero + parts.field("s").to_numpy()[part]
        order = np.argsort(start)
        start = start[order]
        reach = np.maximum.accumulate((zero + parts.field("e").to_numpy()[part])[order])
        first = np.ones(len(start), dtype=bool)
        first[1:] = start[1:] > reach[:-1]
        begin = np.flatnonzero(first)
        start, end = start[begin], reach[np.append(begin[1:], len(reach)) - 1]
        offsets = np.searchsorted(start >> 32, np.arange(batch.num_rows + 1))
        low = [pa.array(v & 0xFFFFFFFF, pa.int32()) for v in (start, end)]
        runs = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(low, names=["s", "e"]))
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("tkey")), runs], names=["tkey", "runs"])


def covered_runs(found: DataFrame) -> DataFrame:
    """(tkey, runs): what the spans of ``repeated`` cover."""
    return found.select("tkey", "spans").mapInArrow(_runs, "tkey binary, runs array<struct<s:int,e:int>>")


def _pieces(length: int):
    """The ``runs`` of ``length`` bytes or more as texts (``piece``: the key) that start at ``lo``."""
    kinds = (pa.binary(), pa.int32(), pa.binary(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in small(batch, SLICE_BYTES):
                rows = [
                    (tkey, r["s"], hashlib.md5(text[r["s"] : r["e"]]).digest(), text[r["s"] : r["e"]])
                    for text, tkey, runs in zip(texts_of(part), texts_of(part, "tkey"), texts_of(part, "runs"), strict=True)
                    for r in runs
                    if r["e"] - r["s"] >= length
                ]
                if rows:
                    columns = zip(zip(*rows, strict=True), kinds, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], names=["tkey", "lo", "piece", TEXT])

    return run


def repeated_within(texts: DataFrame, runs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``repeated(texts, length, gram)``, from the ``covered_runs`` of a lesser length.

    All bytes of a longer repeat are in shorter ones, so it lies in a run that those cover:
    the runs of ``length`` bytes or more are searched as texts of their own.
    """
    runs = runs.where(F.exists("runs", lambda r: r["e"] - r["s"] >= length))
    pieces = texts.join(runs, "tkey").select("tkey", TEXT, "runs")
    pieces = materialize(pieces.mapInArrow(_pieces(length), f"tkey binary, lo int, piece binary, {TEXT} binary"), "pieces")
    found = repeated(pieces.select(F.col("piece").alias("tkey"), TEXT), length, gram)
    found = pieces.select("tkey", "lo", "piece").distinct().join(found.withColumnRenamed("tkey", "piece"), "piece")

    def moved(x):
        return F.struct(F.transform(x["los"], lambda at: at + F.col("lo")).alias("los"), x["s"].alias("s"), x["e"].alias("e"))

    found = found.select("tkey", F.transform("spans", moved).alias("spans"))
    return found.groupBy("tkey").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats(
    docs: DataFrame,
    text_col: str = "text",
    length: int = LENGTH,
    as_text: bool = False,
    least_words: int = 0,
    gram: int = GRAM,
    passages: bool = False,
) -> DataFrame:
    """``__row``, n_bytes, n_removed, n_spans and ``kept`` (binary: the bytes that stay).

    ``as_text``: ``kept`` is a string, without what is left of cut characters.
    ``least_words``: runs of covered bytes with fewer words (between ASCII white
    space; a part of a word counts) stay. ``gram``: bytes of an anchor, a power of
    two below ``length``. ``passages``: also n_passages and passage_bytes, the runs
    of PASSAGE_WORDS words or more that repeats of PASSAGE_BYTES bytes (at most
    ``length``) cover, whether removed or not. Texts are judged as given, not by what is left of
    others; matches never cross texts, all copies go. Null and empty texts have
    no bytes; equal rows are copies of each other; very long texts are cut whole,
    in slices of their windows; an empty table gives no rows.
    """
    rows = with_row(docs, text_col, text_key(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("tkey"))
    long = rows.where(F.length(TEXT) >= (PASSAGE_BYTES if passages else length)).select("tkey", TEXT)
    if passages:
        brief = materialize(covered_runs(repeated(long, PASSAGE_BYTES, PASSAGE_GRAM)), "runs")
        found = covered_runs(repeated_within(long, brief, length, gram))
        found = brief.withColumnRenamed("runs", "brief").join(found, "tkey", "left")
    else:
        found = covered_runs(repeated(long, length, gram)).withColumn("brief", F.lit(None).cast("int"))
    # The text goes through the shuffle once, inside the row.
    joined = rows.select(ROW, "tkey").join(found, "tkey", "left")
    joined = joined.select(ROW, F.col(f"{ROW}.`{text_col}`").cast("binary").alias(TEXT), "runs", "brief")
    names = ["n_bytes", "n_removed", "n_spans"] + ["n_passages", "passage_bytes"] * passages

    def cut(text: bytes, runs: list[dict] | None, words: int) -> list[tuple[int, int]]:
        found = [(r["s"], r["e"]) for r in runs or ()]
        return [(s, e) for s, e in found if not words or len(text[s:e].split()) >= words]

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out: dict[str, list] = {name: [] for name in [*names, "kept"]}
        for text, runs, brief in zip(texts_of(batch), texts_of(batch, "runs"), texts_of(batch, "brief"), strict=True):
            text = text or b""
            cuts = cut(text, runs, least_words)
            kept, at = [], 0
            for s, e in cuts:
                kept.append(text[at:s])
                at = e
            kept.append(text[at:])
            left = b"".join(kept)
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(left))
            out["n_spans"].append(len(cuts))
            out["kept"].append(left.decode("utf-8", "ignore") if as_text else left)
            if passages:
                shared = cut(text, brief, PASSAGE_WORDS)
                out["n_passages"].append(len(shared))
                out["passage_bytes"].append(sum(e - s for s, e in shared))
        last = pa.string() if as_text else pa.binary()
        return {k: pa.array(v, last if k == "kept" else pa.int64()) for k, v in out.items()}

    fields = [field(k, T.LongType()) for k in names]
    kept = field("kept", T.StringType() if as_text else T.BinaryType())
    return add_columns(joined, compute, [*fields, kept])


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and its passages that repeat.

    n_passages and passage_bytes count the runs of 50 words or more, those below ``LENGTH`` bytes
    too; has_passage is whether there are any.
    """
    return remove_repeats(docs.select("doc_id", "text"), passages=True).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        "n_passages",
        "passage_bytes",
        (F.col("n_passages") > 0).alias("has_passage"),
    )
