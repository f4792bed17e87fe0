"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words by weight. A source stops at ``MAX_EPOCHS``
times its size, and what it leaves is shared by the others by weight, until
no source is above its cap. A source's target is then met by whole
repetitions of all its documents and one fractional repetition: its documents
in the order of a seeded hash, as far as the words that are missing reach;
the document at the border is taken in part.

DataFrame functions alone. Scale: a document carries its id, source, size and
hash; the order is never sorted as a whole. The border is found by sums over
4096 hash bins of each source, then over 4096 bins of the border bin, whose
distinct (hash, id, size) are then put in order. The n equal rows at the border
are dealt by their row numbers into about sqrt(n) pieces, and only the rows of
the piece at the border are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from percepta.llm.common import materialize

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"


def text_size(text: str | Column) -> Column:
    """The number of words of a text; 0 for null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORDS)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, rank): sources by code point, null last, from (source, size)."""
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = F.col("source").asc_nulls_last()
    numbered = sums.repartitionByRange(order).sortWithinPartitions(order)
    numbered = materialize(numbered.withColumn("id", F.monotonically_increasing_id()), "sources")
    numbered = numbered.withColumn("part", F.shiftright("id", 33))
    counts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # A row for each partition of the sources.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    local = F.col("id") - F.shiftleft(F.col("part"), 33)
    return numbered.join(offsets, "part").select("source", "source_size", (F.col("offset") + local).alias("rank"))


def water_level(sources: DataFrame, budget: float, epochs: int) -> float:
    """The level: a source's target is its weight times it, or its cap if that is less.

    Each round shares what the capped sources leave among the others; the
    capped ones only become more, so it ends after a few sums.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    if not total:
        return 0.0
    cap = epochs * F.col("source_size")
    capped, level = -1, 0.0
    while True:
        above = F.col("weight") * F.lit(level) > cap
        row = sources.agg(
            F.sum(above.cast("long")).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("used"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if row.n == capped or not row.weight:
            return level
        capped, level = row.n, (budget * total - row.used) / row.weight


def _border(rows: DataFrame, piece: Column, start: str) -> DataFrame:
    """Of rows (source, size, hash, room): the bin of ``piece`` where ``room`` ends, and the words before it.

    ``start``: the name of the column with the words before the rows.
    """
    bins = rows.groupBy("source", piece.alias("bin")).agg(
        F.sum("size").alias("size"), F.first("room").alias("room"), F.first(start).alias("start")
    )
    upto = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    run = bins.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(upto), F.lit(0)))
    here = (F.col("before") <= F.col("room")) & (F.col("room") < F.col("before") + F.col("size"))
    return run.where(here).select(F.col("source").alias("of"), "bin", "before")


def _entry(rows: DataFrame) -> DataFrame:
    """Of rows of the border bin: the distinct (hash, id, size) where ``room`` ends, its rows and the words before it."""
    kinds = rows.groupBy("source", "hash", "doc_id", "size").agg(
        F.count(F.lit(1)).alias("n"), F.first("room").alias("room"), F.first("before2").alias("start")
    )
    words = F.col("n") * F.col("size")
    upto = Window.partitionBy("source").orderBy("hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = kinds.withColumn("before", F.col("start") + F.coalesce(F.sum(words).over(upto), F.lit(0)))
    here = (F.col("before") <= F.col("room")) & (F.col("room") < F.col("before") + words)
    return run.where(here).select("source", "hash", "doc_id", "size", "n", "before").toDF(
        "of", "hash3", "id3", "size3", "n3", "before3"
    )


def _share(rows: DataFrame) -> DataFrame:
    """``part`` of the equal rows in the pieces at the border: whole, then one in part, then nothing."""
    upto = Window.partitionBy("source").orderBy("rid").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("before4") + F.coalesce(F.sum("size").over(upto), F.lit(0))
    return rows.withColumn("part", F.greatest(F.lit(0), F.least("size", F.col("room") - before)))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken of every document.

    ``target``: the words that its source is to give; ``taken``: the words
    that the mix takes of the document, repetitions counted. Null and empty
    texts have size 0 and give nothing; documents with a null source are one
    source, the last; rows equal in id and text are told apart by nothing,
    and which of them is taken is of no account; an empty table gives no rows.
    Very long texts count whole; other columns are ignored, whatever their names.
    Reruns agree: the order is a hash of seed, id and text.
    """
    text, doc = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    key = F.concat_ws(
        "|", F.lit(seed), F.coalesce(doc.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    )
    sized = materialize(
        docs.select(
            doc.alias("doc_id"),
            F.col(f"`{source_col}`").alias("source"),
            text_size(text).alias("size"),
            F.md5(key.cast("binary")).alias("hash"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "sized",
    )
    sources = ranked_sources(sized)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialize(sources.withColumn("weight", weight), "weights")
    level = water_level(sources, budget, epochs)
    target = F.least(F.col("weight") * F.lit(level), (epochs * F.col("source_size")).cast("double"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    room = F.floor(F.col("target") - F.col("whole") * F.col("source_size") + 0.5)
    sources = sources.withColumn("target", target).withColumn("whole", whole.cast("long"))
    sources = sources.withColumn("room", room.cast("long")).withColumnRenamed("source", "of")
    same = F.col("source").eqNullSafe(F.col("of"))
    rows = sized.join(sources, same).drop("of").withColumn("zero", F.lit(0).cast("long"))
    # One row for each source: written, so that its size is known to the join.
    first = materialize(_border(rows, F.substring("hash", 1, 3), "zero"), "bins").toDF("of", "bin1", "before1")
    inside = rows.join(first, same).drop("of").where(F.substring("hash", 1, 3) == F.col("bin1"))
    second = materialize(_border(inside, F.substring("hash", 4, 3), "before1"), "bins").toDF("of", "bin2", "before2")
    inside = inside.join(second, same).drop("of").where(F.substring("hash", 4, 3) == F.col("bin2"))
    third = materialize(_entry(inside), "entries")
    # As many pieces as rows in each, whatever the number of equal rows.
    piece = F.pmod(F.xxhash64("rid"), F.ceil(F.sqrt("n3")).cast("long"))
    at_entry = (F.col("hash") == F.col("hash3")) & F.col("doc_id").eqNullSafe(F.col("id3")) & (F.col("size") == F.col("size3"))
    equal = inside.join(third, same).drop("of").where(at_entry)
    fourth = materialize(_border(equal, piece, "before3"), "bins").toDF("of4", "bin4", "before4")
    last = third.join(fourth, F.col("of").eqNullSafe(F.col("of4"))).drop("of4")
    rows = rows.join(materialize(last, "borders"), same, "left").drop("of")
    key, entry = F.struct("hash", "doc_id", "size"), F.struct("hash3", "id3", "size3")
    # Without a border all documents fit (room is the whole source only if it rounds up to it) or room is 0.
    none = F.col("hash3").isNull()
    outside = rows.where(none | ~at_entry | (piece != F.col("bin4"))).withColumn(
        "part",
        F.when(none, F.when(F.col("room") > 0, F.col("size")).otherwise(F.lit(0)))
        .when(at_entry, F.when(piece < F.col("bin4"), F.col("size")).otherwise(F.lit(0)))
        .when(key < entry, F.col("size"))
        .otherwise(F.lit(0)),
    )
    at = _share(rows.where(~none & at_entry & (piece == F.col("bin4"))))
    return outside.unionByName(at).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + F.col("part")).cast("long").alias("taken"),
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mix(docs).drop("source")
