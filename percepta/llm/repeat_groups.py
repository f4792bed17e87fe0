"""The groups behind the removal of repeats: maximal repeats with all their occurrences.

The anchors and contexts are those of ``repeats``. All contexts of an anchor
that is found twice go through the suffix array, a context that itself is found
twice or more as two blocks, so that its copies are a repeat like any other.
The stack scan of the tree of common-prefix intervals gives the maximal repeats
of the contexts; each occurrence in a context stands for one at every place of
the context, and these are joined back to the documents.

A string of ``length`` bytes or more that lies in an anchor's context has the
same anchor wherever it occurs, so a group holds all occurrences of its string in
the table. A repeat that reaches beyond an anchor's windows is in several groups,
one for each anchor (or part of one, see ``repeats``), that overlap.

Scale: as in ``repeats``; an anchor whose blocks are over ``GROUP_BYTES`` is split
by window starts. Tasks of the suffix arrays are as many as the contexts' bytes ask
for. The result has a row for each occurrence of each group, so it grows with the
copies; nothing is expanded into pairs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from percepta.llm.common import TEXT, materialize, text_key
from percepta.llm.repeats import (
    BLOCK_BYTES,
    GRAM,
    GROUP_BYTES,
    LENGTH,
    OCCURRENCE,
    PARTS,
    SuffixArray,
    _contexts,
    _finer_level,
    _first_level,
)

#: Context bytes for one task of the suffix arrays.
TASK_BYTES = 8 << 20
#: The occurrence of group ``number`` of an anchor ``at`` bytes behind the start of a context.
GROUP = "key long, number int, length int, ctx long, at int"


def context_groups(
    contexts: list[bytes], twice: list[bool], length: int = LENGTH
) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, [(context, offset)]) of each maximal repeat; contexts with ``twice`` have copies."""
    of = [*range(len(contexts)), *(k for k, again in enumerate(twice) if again)]
    blocks = [contexts[k] for k in of]
    ends = np.cumsum([len(b) for b in blocks])
    begins = ends - [len(b) for b in blocks]
    data = np.frombuffer(b"".join(blocks), dtype=np.uint8)
    starts = np.concatenate([np.arange(b, e - length + 1) for b, e in zip(begins, ends, strict=True)])
    left = np.empty(len(data), dtype=np.int64)
    left[1:] = data[:-1]
    left[begins] = -1 - np.arange(len(begins))
    for size, places in SuffixArray(data, ends, starts, length).maximal_repeats(left):
        block = np.searchsorted(ends, places, side="right")
        offsets = (places - begins[block]).tolist()
        yield size, sorted({(of[b], at) for b, at in zip(block.tolist(), offsets, strict=True)})


def _groups(length: int, block_bytes: int, most: int = 50_000):
    """Rows (key, ctx, twice, data) sorted by key, to the ``GROUP`` rows of their repeats."""
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
    names = [f.split()[0] for f in GROUP.split(", ")]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*out, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns], names=names)

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        number: Counter = Counter()
        out: list[tuple] = []
        for size, spots in context_groups([r[3] for r in rows], [r[2] for r in rows], length):
            key = rows[spots[0][0]][0]
            out += [(key, number[key], size, rows[k][1], at) for k, at in spots]
            number[key] += 1
            if len(out) >= most:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if rows and rows[-1][0] != row[0] and held >= block_bytes:
                    yield from solve(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[3]) * (1 + row[2])
        if rows:
            yield from solve(rows)

    return run


def repeat_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    group_bytes: int = GROUP_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """key, number, length, id and start: a row for each occurrence of each repeated string.

    A group is a (key, number): a string of ``length`` bytes or more that occurs twice
    or more, and cannot be made longer in the windows of its anchor. Its rows are all of
    its occurrences; the bytes that groups cover are those that ``remove_repeats``
    removes. Rows of equal text are occurrences each, with their own ids, null ids too;
    null, empty and shorter texts have none; very long texts are taken whole; matches
    are of bytes, malformed or not; an empty table gives no rows. Other columns are
    ignored, whatever their names.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("binary").alias(TEXT),
        text_key(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("tkey"),
    ).where(F.length(TEXT) >= length)
    # Equal texts once; ``copies`` stands for all of them.
    once = materialize(
        rows.groupBy("tkey").agg(F.first(TEXT).alias(TEXT), F.count(F.lit(1)).alias("copies")), "group-texts"
    )
    copies = once.select("tkey", "copies")
    parts = []
    level = once.mapInArrow(_first_level(length, gram), OCCURRENCE)
    for step in (*PARTS, None):
        found = materialize(level.join(copies, "tkey"), "group-anchors")
        places = F.size("los") * F.col("copies")
        shared = found.groupBy("key").agg(F.sum(places).alias("n")).where("n > 1").select("key")
        # A plain table on this side lets the join split a hot key.
        found = materialize(found.join(materialize(shared, "group-keys"), "key").drop("copies"), "group-shared")
        one = F.min(F.struct("tkey", "span", F.col("los")[0].alias("lo")))
        contexts = found.join(copies, "tkey").groupBy("key", "ctx")
        contexts = materialize(contexts.agg((F.sum(places) > 1).alias("twice"), one.alias("one")), "group-contexts")
        size = F.sum((F.col("one.span") + length) * F.when(F.col("twice"), 2).otherwise(1))
        hot = contexts.groupBy("key").agg(size.alias("size")).where(F.col("size") > group_bytes)
        hot = materialize(hot.select("key"), "group-hot")
        # The last parts are single windows: one context each, however often it is found.
        here = contexts if step is None else contexts.join(hot, "key", "left_anti")
        total = here.agg(size.alias("size")).first().size or 0
        fetch = here.groupBy("one.tkey").agg(
            F.collect_list(F.struct("key", "ctx", F.col("one.span").alias("span"), F.col("one.lo").alias("lo"))).alias("places")
        )
        data = once.join(fetch, "tkey").select(TEXT, "places")
        data = data.mapInArrow(_contexts(length), "key long, ctx long, data binary")
        data = data.join(here.select("key", "ctx", "twice"), ["key", "ctx"]).select("key", "ctx", "twice", "data")
        solved = (
            data.repartition(int(total // TASK_BYTES) + 1, "key")
            .sortWithinPartitions("key", "ctx")
            .mapInArrow(_groups(length, block_bytes), GROUP)
        )
        solved = materialize(solved, "group-repeats")
        spots = found.select("key", "ctx", "tkey", F.explode("los").alias("lo"))
        spots = solved.join(spots, ["key", "ctx"])
        parts.append(spots.select("key", "number", "length", "tkey", (F.col("lo") + F.col("at")).alias("start")))
        if step is None or hot.isEmpty():
            break
        fetch = found.join(hot, "key", "left_semi").groupBy("tkey")
        fetch = fetch.agg(F.collect_list(F.struct("key", "off", "span", "los")).alias("places"))
        level = once.join(fetch, "tkey").select(TEXT, "tkey", "places")
        level = level.mapInArrow(_finer_level(length, gram, step), OCCURRENCE)
    every = parts[0]
    for more in parts[1:]:
        every = every.unionByName(more)
    ids = rows.select("id", "tkey")
    return ids.join(every, "tkey").select("key", "number", "length", "id", "start")
