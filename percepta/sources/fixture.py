"""A labelled passenger-like table derived from ``orders``.

The driver's tables have no NULLs and no classification target, so the test
table is made from ``orders`` by key: every column of the passenger table has
a stand-in (see ``spec.FIXTURE``), with NULLs at fixed key residues and a
label that is a learnable rule of three columns. It grows with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The same view as ANSI SQL over the ``orders`` table (runs on Spark and DuckDB).
FIXTURE_SQL = """SELECT o_orderkey AS entity_id,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(EXTRACT(DAY FROM o_orderdate) AS DOUBLE) END AS tenure,
 CASE WHEN o_orderkey % 418 = 153 THEN NULL ELSE o_totalprice END AS amount,
 CAST(o_custkey % 3 + 1 AS INT) AS tier,
 CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'female' ELSE 'male' END AS grp,
 CAST(o_custkey % 7 AS INT) AS n_side, CAST(o_custkey % 5 AS INT) AS n_up,
 CASE WHEN o_orderkey % 446 = 0 THEN NULL WHEN o_orderstatus='F' THEN 'S' WHEN o_orderstatus='O' THEN 'C' ELSE 'Q' END AS site,
 CASE WHEN (o_orderpriority IN ('1-URGENT','2-HIGH') AND o_custkey % 3 < 2) OR o_totalprice > 400000 THEN 1 ELSE 0 END AS label
 FROM orders"""

ORDERS_COLUMNS = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def passengers_from_orders(orders: DataFrame) -> DataFrame:
    """Project ``orders`` into the fixture columns (narrow: no shuffle)."""
    key = F.col("o_orderkey")
    cust = F.col("o_custkey")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    status = F.col("o_orderstatus")
    return orders.select(
        key.alias("entity_id"),
        F.when(key % 5 == 0, F.lit(None))
        .otherwise(F.dayofmonth("o_orderdate").cast("double"))
        .alias("tenure"),
        F.when(key % 418 == 153, F.lit(None))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
        (cust % 3 + 1).cast("int").alias("tier"),
        F.when(urgent, "female").otherwise("male").alias("grp"),
        (cust % 7).cast("int").alias("n_side"),
        (cust % 5).cast("int").alias("n_up"),
        F.when(key % 446 == 0, F.lit(None))
        .when(status == "F", "S")
        .when(status == "O", "C")
        .otherwise("Q")
        .alias("site"),
        F.when((urgent & (cust % 3 < 2)) | (F.col("o_totalprice") > 400000), 1)
        .otherwise(0)
        .alias("label"),
    )


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture table for one scale factor directory."""
    return passengers_from_orders(read_table(spark, sf_dir, "orders"))
