"""Case records built from the star-schema tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FROM_PART = {"product", "sub_product", "issue"}
_FROM_SUPPLIER = {"company"}
_FROM_LINE = {"date_sent_to_company", "consumer_disputed"} | _FROM_PART | _FROM_SUPPLIER

CASE_COLUMNS = [
    "complaint_id",
    "date_received",
    "date_sent_to_company",
    "company",
    "product",
    "sub_product",
    "issue",
    "state",
    "company_response",
    "submitted_via",
    "consumer_consent_provided",
    "company_public_response",
    "consumer_disputed",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def first_lines(lineitem: DataFrame) -> DataFrame:
    """The first line of every order.

    The minimum of a struct is found per map task before the shuffle, so an order that holds a
    third of all lines still sends one row per task.
    """
    line = F.struct(
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
    )
    return (
        lineitem.groupBy("l_orderkey")
        .agg(F.min(line).alias("line"))
        .select("l_orderkey", "line.l_partkey", "line.l_suppkey", "line.l_returnflag", "line.l_shipdate")
    )


def cases(spark: SparkSession, folder: str, columns: Iterable[str] = CASE_COLUMNS) -> DataFrame:
    """Case records with the asked columns; lookups that no asked column needs are not joined.

    Part and supplier are looked up on their primary keys by left joins, so leaving one out keeps
    the rows. No side is hinted: Catalyst broadcasts only what its size statistics allow, and AQE
    splits skewed partitions of the joins that shuffle.
    """
    columns = list(columns)
    wanted = set(columns)
    placed = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    rows = placed.join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    if wanted & _FROM_LINE:
        rows = rows.join(
            first_lines(table(spark, folder, "lineitem")), F.col("l_orderkey") == F.col("o_orderkey"), "left"
        )
    if wanted & _FROM_PART:
        rows = rows.join(table(spark, folder, "part"), F.col("p_partkey") == F.col("l_partkey"), "left")
    if wanted & _FROM_SUPPLIER:
        rows = rows.join(table(spark, folder, "supplier"), F.col("s_suppkey") == F.col("l_suppkey"), "left")
    disputed = (F.col("o_orderstatus") == "F") & F.col("l_returnflag").isin("R", "A")
    values = {
        "complaint_id": F.col("o_orderkey").cast("string"),
        "date_received": F.col("o_orderdate").cast("timestamp"),
        "date_sent_to_company": F.col("l_shipdate").cast("timestamp"),
        "company": F.col("s_name"),
        "product": F.col("p_type"),
        "sub_product": F.col("p_brand"),
        "issue": F.col("p_name"),
        "state": F.col("n_name"),
        "company_response": F.col("o_orderstatus"),
        "submitted_via": F.col("o_orderpriority"),
        "consumer_consent_provided": F.when(F.col("o_orderkey") % 7 != 0, F.col("c_mktsegment")),
        "company_public_response": F.when(F.col("o_orderkey") % 3 == 0, "Closed"),
        "consumer_disputed": F.when(disputed, "Yes").otherwise("No"),
    }
    return rows.select(*[values[name].alias(name) for name in columns])
