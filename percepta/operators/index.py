"""String indexing of categorical columns (Spark ML ``StringIndexer``).

The labels of a fitted indexer live on the driver and travel to every task
inside the indexing expression, so it is for categorical columns. A column
with very many values is indexed by ``label_table`` and ``index_by_join``
instead: the labels stay a table, and the rows are joined with it, those of
common values by broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from percepta.session import shared_dir

ORDERS = ("frequencyDesc", "frequencyAsc", "alphabetDesc", "alphabetAsc")


def _outputs(input_cols: Sequence[str], output_cols: Sequence[str] | None) -> list[str]:
    return list(output_cols or [f"{c}Index" for c in input_cols])


def index_pipeline(
    input_cols: Sequence[str],
    output_cols: Sequence[str] | None = None,
    handle_invalid: str = "skip",
    order: str = "frequencyDesc",
) -> Pipeline:
    """An unfitted pipeline indexing each input column to a double code.

    ``frequencyDesc``: most frequent value -> 0.0, ties alphabetical.
    ``handle_invalid="skip"`` drops rows with NULL or unseen values.
    """
    indexer = StringIndexer(
        inputCols=list(input_cols),
        outputCols=_outputs(input_cols, output_cols),
        handleInvalid=handle_invalid,
        stringOrderType=order,
    )
    return Pipeline(stages=[indexer])


def fit_index(
    df: DataFrame,
    input_cols: Sequence[str],
    output_cols: Sequence[str] | None = None,
    handle_invalid: str = "skip",
    order: str = "frequencyDesc",
) -> PipelineModel:
    """``index_pipeline`` fitted on ``df`` (NULLs are not labels)."""
    return index_pipeline(input_cols, output_cols, handle_invalid, order).fit(df)


def label_table(df: DataFrame, column: str) -> DataFrame:
    """``value``, ``idx`` (double), ``n``: the labels by falling frequency, ties alphabetical, and their rows.

    Numbered by range partitions, each from its own offset, so no task sees
    all labels; written to the shared folder, so that the numbers are fixed.
    """
    value = F.col(column).cast("string").alias("value")
    counts = df.select(value).where("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    numbered = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = numbered.withColumn("id", F.monotonically_increasing_id())
    path = shared_dir(df.sparkSession, "labels")
    numbered.write.parquet(path)
    numbered = df.sparkSession.read.parquet(path).withColumn("part", F.shiftright("id", 33))
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    local = F.col("id") - F.shiftleft(F.col("part"), 33)
    idx = (F.col("offset") + local).cast("double").alias("idx")
    return numbered.join(offsets, "part").select("value", idx, "n")


#: A value with more than one of so many rows is common: fewer than this are.
COMMON = 1000


def index_by_join(df: DataFrame, column: str, output: str, labels: DataFrame | None = None) -> DataFrame:
    """``df`` with the index of ``column``; rows with NULL or unseen values are dropped.

    Rows with a common value (more than one in ``COMMON`` of the rows that ``labels``
    counted, so fewer than ``COMMON`` values) meet their labels by broadcast and are never
    shuffled; the others are joined by value, and no value among them is a hot key.
    """
    labels = label_table(df, column) if labels is None else labels
    total = labels.agg(F.sum("n")).first()[0] or 0
    value, idx = F.col("value").alias("_index_value"), F.col("idx").alias(output)
    common = F.broadcast(labels.where(F.col("n") * COMMON > total).select(value, idx))
    rare = labels.where(F.col("n") * COMMON <= total).select(value, idx)
    same = F.col(column).cast("string") == F.col("_index_value")
    found = df.join(common, same).drop("_index_value")
    others = df.where(F.col(column).isNotNull()).join(common, same, "left_anti").join(rare, same).drop("_index_value")
    return found.unionByName(others)


def labels_of(model: PipelineModel | StringIndexerModel) -> dict[str, list[str]]:
    """``{input column: labels in index order}`` of every indexer in ``model``."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    out: dict[str, list[str]] = {}
    for stage in stages:
        if not isinstance(stage, StringIndexerModel):
            continue
        cols = stage.getInputCols() if stage.isSet("inputCols") else [stage.getInputCol()]
        for col, labels in zip(cols, stage.labelsArray, strict=True):
            out[col] = list(labels)
    return out


def index_labels(spark: SparkSession, model: PipelineModel | StringIndexerModel) -> DataFrame:
    """The fitted labels as a table: ``column``, ``value``, ``idx`` (double)."""
    rows = [
        (col, value, float(i)) for col, labels in labels_of(model).items() for i, value in enumerate(labels)
    ]
    schema = T.StructType(
        [
            T.StructField("column", T.StringType(), False),
            T.StructField("value", T.StringType(), False),
            T.StructField("idx", T.DoubleType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)
