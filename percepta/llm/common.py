"""Helpers shared by the training-data operators.

Row identity: ids may be null or repeat, so operators never join rows on
them. They either add columns to each row (``with_row``: the input row rides
along as one struct, so no column name can clash) or key by the text itself
(``text_key``).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.session import shared_dir

ROW = "__row"
TEXT = "__text"

#: A-Z to lower case, every other byte that is no digit, letter or part of a
#: multi-byte character to a space: ``translate(...).split()`` gives the words
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text, as bytes.
PLAIN_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where the driver found it by its own ``sys.path`` (a local session
    started elsewhere); on a cluster, ship it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def plain_words(text: bytes | None) -> list[bytes]:
    return text.translate(PLAIN_WORDS).split() if text else []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage with a table that every executor sees, so a lost
    executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: str | Column) -> Column:
    """16 bytes that stand for a text (its MD5)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(c.cast("binary")))


def id_crc(doc_id: str | Column) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def with_row(df: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """The whole row as struct ``__row``, the text as binary ``__text``, and ``more``."""
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW),
        F.col(f"`{text_col}`").cast("binary").alias(TEXT),
        *more,
    )


def add_columns(
    df: DataFrame,
    compute: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    fields: list[T.StructField],
    keep: tuple[str, ...] = (ROW,),
    setup: Callable[[], None] | None = None,
) -> DataFrame:
    """``keep`` columns of ``df`` plus the columns that ``compute`` makes of each Arrow batch.

    One narrow stage; memory is bounded by a batch.
    """
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if setup:
            setup()
        for batch in batches:
            for part in small(batch):
                made = compute(part)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in keep]
                    + [made[n] for n in names],
                    names=[*keep, *names],
                )

    return df.mapInArrow(run, schema)


def small(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes, so that very long texts do not pile up."""
    n = batch.num_rows
    step = max(1, int(n * most / max(batch.nbytes, 1)))
    for i in range(0, n, step):
        yield batch.slice(i, step)


def decoded(text: bytes | None) -> str:
    """The text of UTF-8 bytes; malformed bytes become U+FFFD, null the empty text."""
    return (text or b"").decode("utf-8", "replace")


def texts_of(batch: pa.RecordBatch, name: str = TEXT) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, True)
