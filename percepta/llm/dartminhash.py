"""Near-duplicate detection with DartMinHash signatures.

A text is its runs of ``SHINGLE`` words (``common.plain_words``; a shorter
text is one run), each as heavy as it is frequent in the text (or, with
``weighted=False``, of weight 1). Signatures: darts fall at random, but fixed by the
element's hash, on the plane of weight and rank above each element, one for a
unit of area on average. The darts below the element's weight and a rank
limit hit; each hit names one of ``COORDINATES`` coordinates, and the
coordinate keeps the hit of least rank. The limit is set so that all
coordinates are hit almost surely (about k log k darts for any text size), and
doubled for texts that miss one. Two texts agree in a coordinate with the
probability of their weighted Jaccard similarity: the sum of the lesser
weights by the sum of the greater ones.

Links are found by bands of the signature and decided on the shingles
themselves, the n-th occurrence of a run being an element of its own, so that
the weighted similarity is that of sets:

1. exact copies (equal text) become one text;
2. bands shared by two texts or more: each text is compared with the least
   text of its band, and the links' connected components taken;
3. what still lies in different components within a band is compared there,
   in blocks of bounded size, keeping only the links that join components:
   the texts outside the band's largest component with those inside it and
   with each other.

So no pair is lost that shares a band, and pairs within a component are not
expanded. Bands: 32 of 6 coordinates, which miss a pair of similarity 0.8
with probability 6e-5.

Scale: band rows are 16 bytes and combined before the shuffle; only texts
that share a band carry shingles (4 bytes each); a hot band is cut into blocks of
about ``BLOCK_TEXTS`` texts and ``BLOCK_BYTES`` of shingles, compared block by
block. A large group with a few texts that are not linked to it costs as much as
the group for each block of those few.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import exp, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.llm.common import (
    ROW,
    TEXT,
    add_columns,
    field,
    materialize,
    plain_words,
    small,
    text_key,
    texts_of,
    with_row,
)

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 6
COORDINATES = BANDS * ROWS
BLOCK_TEXTS = 512
BLOCK_BYTES = 8 << 20
SLICE_BYTES = 256 << 10
#: Rank bands: [0, 2^LOWEST), [2^LOWEST, 2^(LOWEST+1)), ...
LOWEST = -6
#: Greatest area of a part of the plane whose darts one hash draws.
CELL_AREA = 256
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_WORDS: dict[bytes, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts from uniform numbers, by the inverse distribution."""
    steps, p, total = [], exp(-mean), 0.0
    k = 0
    while total < 1 - 1e-16 and k < mean + 40 * (mean**0.5 + 1):
        total += p
        steps.append(total)
        k += 1
        p *= mean / k
    return np.searchsorted(np.array(steps), u, side="right")


def shingle_counts(text: bytes | None, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct 64-bit hashes of a text's word runs, sorted, and how often each occurs; none without words."""
    words = plain_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if len(_WORDS) > 300_000:
        _WORDS.clear()
    hashed = []
    for w in words:
        h = _WORDS.get(w)
        if h is None:
            h = _WORDS[w] = xxhash.xxh3_64_intdigest(w)
        hashed.append(h)
    ids = np.array(hashed, dtype=np.uint64)
    size = min(n, len(ids))
    count = len(ids) - size + 1
    key = np.full(count, size, dtype=np.uint64)
    for j in range(size):
        key = _mix(key * _GOLD + ids[j : j + count])
    return np.unique(key, return_counts=True)


def occurrences(element: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A hash for each occurrence of each element; the first one's is the element."""
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    base = np.repeat(element, count)
    later = nth > 0
    base[later] = _mix(base[later] + nth[later].astype(np.uint64) * _GOLD)
    return base


def _darts(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, limit: np.ndarray):
    """(owner, rank, id) of the darts below weight and rank limit.

    ``limit`` is by owner. Cells of the plane are dyadic in weight ([0, 1),
    [1, 2), [2, 4), ...) and in rank, large ones cut into parts of area
    ``CELL_AREA`` by rank; a part's number of darts is Poisson of its area,
    drawn from a hash of the element and part.
    """
    owners, ranks, names = [], [], []
    top_rank = float(limit.max())
    level, low, high = 0, 0.0, 1.0
    while low < weight.max():
        of = np.flatnonzero(weight > low)
        cell, start, end = LOWEST, 0.0, 2.0**LOWEST
        while start < top_rank:
            parts = max(1, int((high - low) * (end - start) / CELL_AREA))
            step = (end - start) / parts
            for part in range(parts):
                bottom = start + part * step
                at = of[limit[owner[of]] > bottom]
                if not len(at):
                    break
                place = np.array([level + 1, cell - LOWEST + 1, part], np.uint64) * np.array([_GOLD, _M1, _M2])
                seed = _mix(element[at] ^ place[0] ^ place[1] ^ place[2])
                count = _poisson(_unit(seed), (high - low) * step)
                hit = np.flatnonzero(count)
                if not len(hit):
                    continue
                many = count[hit]
                base = np.repeat(seed[hit], many)
                which = np.arange(len(base)) - np.repeat(np.cumsum(many) - many, many)
                name = _mix(base + (which.astype(np.uint64) + np.uint64(1)) * _GOLD)
                rank = bottom + step * _unit(_mix(name ^ _M2))
                height = low + (high - low) * _unit(_mix(name ^ _M1))
                source = np.repeat(at[hit], many)
                keep = (height < weight[source]) & (rank < limit[owner[source]])
                owners.append(owner[source][keep])
                ranks.append(rank[keep])
                names.append(name[keep])
            cell, start, end = cell + 1, end, end * 2
        level, low, high = level + 1, high, high * 2
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(ranks), np.concatenate(names)


def signatures(
    sets: Sequence[np.ndarray], weights: list[np.ndarray] | None = None, k: int = COORDINATES
) -> np.ndarray:
    """A row of ``k`` 64-bit values for each set of element hashes (zeros for an empty set)."""
    out = np.zeros((len(sets), k), dtype=np.uint64)
    weights = weights or [np.ones(len(s)) for s in sets]
    total = np.array([w.sum() for w in weights])
    todo = np.flatnonzero(total > 0)
    darts = k * log(k) + 2 * k
    while len(todo):
        element = np.concatenate([sets[t] for t in todo])
        weight = np.concatenate([weights[t] for t in todo])
        owner = np.repeat(np.arange(len(todo)), [len(sets[t]) for t in todo])
        whose, rank, name = _darts(element, weight, owner, darts / total[todo])
        slot = whose * k + (_mix(name ^ _GOLD) % np.uint64(k)).astype(np.int64)
        order = np.argsort(rank, kind="stable")[::-1]
        kept = np.zeros(len(todo) * k, dtype=np.uint64)
        full = np.zeros(len(todo) * k, dtype=bool)
        kept[slot[order]] = name[order]  # the least rank is written last
        full[slot] = True
        done = full.reshape(-1, k).all(axis=1)
        out[todo[done]] = kept.reshape(-1, k)[done]
        todo = todo[~done]
        darts *= 2
    return out


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit hash for each band of each signature, different from band to band."""
    parts = signature.reshape(len(signature), bands, -1)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _GOLD + np.zeros((len(parts), 1), np.uint64)
    for j in range(parts.shape[2]):
        key = _mix(key * _GOLD + parts[:, :, j])
    return key.view(np.int64)


def text_bands(texts: DataFrame, weighted: bool = True) -> DataFrame:
    """(tkey, bands) of rows (tkey, ``__text``); texts without words have no bands."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found: list[list[int]] = []
        for part in small(batch, SLICE_BYTES):
            sets, counts = zip(*map(shingle_counts, texts_of(part)), strict=True)
            weights = [c.astype(float) for c in counts] if weighted else None
            bands = band_hashes(signatures(sets, weights))
            found += [b.tolist() if len(s) else [] for s, b in zip(sets, bands, strict=True)]
        return {"bands": pa.array(found, pa.list_(pa.int64()))}

    return add_columns(texts, compute, [field("bands", T.ArrayType(T.LongType()))], keep=("tkey",))


def _shingles(texts: DataFrame, keep: tuple[str, ...], weighted: bool = True) -> DataFrame:
    """Add the low 32 bits of the hashes of shingles (``weighted``: of their occurrences), sorted, as binary."""

    def of(text: bytes | None) -> bytes:
        element, count = shingle_counts(text)
        return np.unique((occurrences(element, count) if weighted else element).astype("<u4")).tobytes()

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"shingles": pa.array([of(t) for t in texts_of(batch)], pa.binary())}

    return add_columns(texts, compute, [field("shingles", T.BinaryType())], keep=keep)


def _similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    joined = np.concatenate([a, b])
    joined.sort()
    both = int((joined[1:] == joined[:-1]).sum())
    return both >= least * (len(joined) - both)


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets (uid, shingles) are similar enough."""
    left = sets.select(F.col("uid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("uid").alias("b"), F.col("shingles").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sa, sb = texts_of(batch, "sa"), texts_of(batch, "sb")
            keep = [
                _similar(np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4"), least)
                for x, y in zip(sa, sb, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(uid, comp): the least node of each node's connected component, for nodes with edges.

    Alternates linking each node's larger and smaller neighbours to its least
    one until nothing changes: a number of rounds that grows with the log of
    the longest path, each a few aggregations without any hot join.
    """
    links = materialize(edges.select("a", "b").where("a <> b").distinct(), name)
    while True:
        # Large star: greater neighbours go to the least of the neighbourhood.
        both = links.union(links.select("b", "a")).toDF("u", "v")
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), name)
        # Small star: lesser neighbours, and the node, go to the least of them.
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = materialize(down.groupBy("u").agg(F.min("v").alias("m")), name)
        small_star = (
            down.join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        new = materialize(small_star, name)
        # Done when every node has one parent, which is no one's child, and nothing moved.
        old = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        sums = [
            t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for t in (old, new)
        ]
        links = new
        if sums[0] == sums[1]:
            break
    nodes = links.select(F.col("a").alias("uid"), F.col("b").alias("comp"))
    roots = links.select(F.col("b").alias("uid"), F.col("b").alias("comp"))
    return nodes.union(roots).distinct()


def block_links(rows: list[tuple[int, int, bytes]], least: float) -> list[tuple[int, int]]:
    """Links between different components among rows (uid, comp, shingles), enough to join them.

    The rows that are not in the largest component are compared with all
    others that do not share their component.
    """
    sets = [np.frombuffer(r[2], "<u4") for r in rows]
    comp = np.array([r[1] for r in rows])
    names, number, count = np.unique(comp, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return []
    number = number.ravel()
    few = np.flatnonzero(number != int(count.argmax()))
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    value = np.concatenate(sets)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    both = np.zeros((len(few), len(sets)), dtype=np.int32)
    for k, i in enumerate(few.tolist()):
        lo = np.searchsorted(value, sets[i], side="left")
        n = np.searchsorted(value, sets[i], side="right") - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        both[k] = np.bincount(owner[at], minlength=len(sets))
    size = np.array([len(s) for s in sets])
    near = both >= least * (size[few][:, None] + size[None, :] - both)
    near &= number[few][:, None] != number[None, :]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for k, j in zip(*np.nonzero(near), strict=True):
        i = few[k]
        pair = (min(number[i], number[j]), max(number[i], number[j]))
        found.setdefault(pair, (rows[i][0], rows[j][0]))
    return list(found.values())


def _residual(least: float):
    """Rows (cell, uid, comp, shingles) sorted by cell, to links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            out = []
            for *key, uid, comp, shingles in zip(*columns, strict=True):
                if key != cell:
                    out += block_links(rows, least) if len(rows) > 1 else []
                    cell, rows = key, []
                rows.append((uid, comp, shingles))
            if out:
                yield _pairs(out)
        if len(rows) > 1:
            yield _pairs(block_links(rows, least))

    return run


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
        names=["a", "b"],
    )


def residual_cells(known: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """(band, i, j, uid, comp): cells where texts of a band in different components meet.

    ``known``: (band, uid, comp, bytes). Blocks -1, -2, ... are of the band's
    largest component, 0, 1, ... of its other texts. A cell is two blocks, one
    at least of the others; blocks of the largest component do not meet.
    """
    size = [F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")]
    comps = known.groupBy("band", "comp").agg(*size)
    bands = comps.groupBy("band").agg(
        F.max(F.struct("n", "bytes", "comp")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")
    )

    def blocks(n: Column, size: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / most), F.ceil(size / most_bytes)).cast("long")

    n, b = F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")
    bands = bands.where(n > 0).select(
        "band",
        F.col("top.comp").alias("top"),
        blocks(F.col("top.n"), F.col("top.bytes")).alias("tops"),
        blocks(n, b).alias("others"),
    )
    # A plain table on this side lets the join split a hot band.
    rows = known.join(materialize(bands, "open"), "band")
    is_top = F.col("comp") == F.col("top")
    hashed = F.xxhash64("uid")
    mine = F.when(is_top, -1 - F.pmod(hashed, "tops")).otherwise(F.pmod(hashed, "others"))
    first = F.when(is_top, F.lit(0).cast("long")).otherwise(-F.col("tops"))
    rows = rows.withColumn("mine", mine)
    rows = rows.withColumn("other", F.explode(F.sequence(first, F.col("others") - 1)))
    return rows.where("mine <> other").select(
        "band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "uid", "comp"
    )


def text_links(
    docs: DataFrame, text_col: str = "text", least: float = SIMILARITY, weighted: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(tkey, uid) of each distinct text that is not null, and links (a, b) between uids.

    Each link is a pair of similar texts; together they join all that
    similar pairs join. Texts without words have no links.
    """
    rows = docs.select(text_key(text_col).alias("tkey"), F.col(f"`{text_col}`").cast("binary").alias(TEXT))
    rows = rows.where(F.col(TEXT).isNotNull())
    texts = text_bands(rows, weighted).groupBy("tkey").agg(F.first("bands").alias("bands"))
    texts = materialize(texts.withColumn("uid", F.monotonically_increasing_id()), "bands")
    banded = texts.select("uid", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("uid").alias("first"), F.count(F.lit(1)).alias("n"))
    # A plain table on this side lets the join split a hot band.
    shared = materialize(shared.where("n > 1"), "shared")
    members = materialize(banded.join(shared, "band"), "members")
    needed = texts.select("tkey", "uid").join(members.select("uid").distinct(), "uid")
    once = rows.groupBy("tkey").agg(F.first(TEXT).alias(TEXT))
    sets = _shingles(once.join(needed, "tkey"), keep=("uid",), weighted=weighted)
    sets = materialize(sets.withColumn("bytes", F.length("shingles")), "shingles")
    pairs = members.where("uid <> first").select(F.col("first").alias("b"), F.col("uid").alias("a")).distinct()
    links = materialize(verified(pairs, sets, least), "links")
    comp = materialize(components(links), "comp")
    # Bands that still hold several components.
    known = members.select("band", "uid").join(comp, "uid", "left").join(sets.select("uid", "bytes"), "uid")
    known = known.withColumn("comp", F.coalesce("comp", "uid"))
    cells = residual_cells(known, BLOCK_TEXTS, BLOCK_BYTES)
    more = (
        cells.join(sets.select("uid", "shingles"), "uid")
        .select("band", "i", "j", "uid", "comp", "shingles")
        .repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
        .mapInArrow(_residual(least), "a long, b long")
    )
    more = materialize(more.distinct(), "more")
    return texts.select("tkey", "uid"), links.union(more)


def near_classes(
    docs: DataFrame, text_col: str = "text", least: float = SIMILARITY, weighted: bool = True
) -> DataFrame:
    """(tkey, uid, class_uid) of each distinct text that is not null; a class has one class_uid.

    Texts without words are in a class only with their exact copies.
    """
    texts, links = text_links(docs, text_col, least, weighted)
    comp = materialize(components(links, "all"), "classes")
    return texts.join(comp, "uid", "left").select("tkey", "uid", F.coalesce("comp", "uid").alias("class_uid"))


def near_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, weighted: bool = True
) -> DataFrame:
    """a, b: links between different texts, each named by the least id that has it (null if no other).

    a <= b. Every row is a pair of similar texts, and the rows connect each class of
    ``near_duplicates`` with as many or more links than a tree needs; pairs
    within a class are not all listed, exact copies and null texts not at
    all. An empty table gives no rows.
    """
    texts, links = text_links(docs, text_col, least, weighted)
    ids = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(text_col).alias("tkey"))
    names = materialize(ids.groupBy("tkey").agg(F.min("id").alias("id")).join(texts, "tkey").select("uid", "id"), "names")
    named = links.join(names.toDF("a", "x"), "a").join(names.toDF("b", "y"), "b")
    none = F.col("x").isNull() | F.col("y").isNull()
    return named.select(
        F.when(none, F.coalesce("x", "y")).otherwise(F.least("x", "y")).alias("a"),
        F.when(~none, F.greatest("x", "y")).alias("b"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weighted: bool = True
) -> DataFrame:
    """id, class_id, class_size, is_first of every row; class_id: the class's least id.

    Classes are the connected components of the similarity links of 0.8 or
    more (and equal texts); similarity weighs each run of words by its number
    in the text, or by 1 (``weighted=False``). A null text is in a class of its own (class_id is
    its id); ``is_first`` marks one row of each class, the one of least id
    (null last); rows equal in id and text are told apart only by it, where
    the first of them is arbitrary but one. An empty table gives no rows.
    Very long texts are compared whole; other columns are ignored, whatever
    their names.
    """
    classes = materialize(near_classes(docs, text_col, weighted=weighted), "near")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_key(text_col).alias("tkey"))
    rows = materialize(rows.withColumn("at", F.monotonically_increasing_id()), "rows")
    tagged = rows.join(classes, "tkey", "left")
    tagged = tagged.withColumn(
        "class", F.when(F.col("class_uid").isNotNull(), F.col("class_uid")).otherwise(-1 - F.col("at"))
    )
    tagged = materialize(tagged.select("id", "at", "class"), "tagged")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("at").alias("at"))
    heads = tagged.groupBy("class").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("class_size"))
    return tagged.join(materialize(heads, "heads"), "class").select(
        "id", F.col("head.id").alias("class_id"), "class_size", (F.col("at") == F.col("head.at")).alias("is_first")
    )


def near_report(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, is_first of every document."""
    return near_duplicates(docs).withColumnRenamed("id", "doc_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns, without all but one of each class: that of least id (null last).

    Rows with a null text stay. Of rows equal in id and text one stays.
    """
    classes = materialize(near_classes(docs, text_col), "near")
    rows = with_row(docs, text_col, text_key(text_col).alias("tkey"))
    alone = rows.where(F.col(TEXT).isNull()).select(ROW)
    order = F.struct(F.col(f"{ROW}.`{id_col}`").isNull().alias("none"), F.col(f"{ROW}.`{id_col}`").alias("id"))
    # One row of each distinct text, combined before the shuffle; then one text of each class.
    first = rows.where(F.col(TEXT).isNotNull()).groupBy("tkey").agg(
        F.min_by(ROW, order).alias(ROW), F.min(order).alias("order")
    )
    ids = rows.where(F.col(TEXT).isNotNull()).groupBy("tkey").agg(F.min(order).alias("order"))
    best = ids.join(classes, "tkey").groupBy("class_uid").agg(
        F.min_by("tkey", F.struct("order", "tkey")).alias("tkey")
    )
    kept = first.join(best.select("tkey"), "tkey", "left_semi").select(ROW)
    return kept.union(alone).select(f"{ROW}.*")
