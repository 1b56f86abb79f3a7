"""The test tables seen as the four raw tables (FIXTURES.md, section 3)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: every 50th customer is listed twice.
LISTED_TWICE = 50
# Lines of a task that joins them with their orders.
LINES_OF_TASK = 500_000
# Months that some people miss, the first of late comers, the last of those who leave.
AWAY, LATE, LEFT = ("199903", "200104"), "200101", "199912"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _day(col: str, fmt: str) -> Column:
    return F.date_format(F.col(col).cast("date"), fmt)


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer in every month from the first order to the last.

    Customers are dealt out before they are repeated for every month: a small file of them makes very many rows.
    """
    order_month = F.trunc(F.col("o_orderdate").cast("date"), "month")
    span = table(spark, sf_dir, "orders").agg(F.sequence(F.min(order_month), F.max(order_month), F.expr("interval 1 month")))
    month = F.explode(span.scalar())
    copies = F.when(F.col("distinct_id") % LISTED_TWICE == 0, 2).otherwise(1)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        customers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        .select(
            F.col("c_custkey").alias("distinct_id"),
            (18 + F.col("c_custkey") % 60).cast("int").alias("age"),
            F.when(F.col("c_mktsegment") == "BUILDING", "F")
            .when(F.col("c_mktsegment") == "MACHINERY", "M")
            .alias("gender"),
            month.alias("month"),
        )
        .select(
            "distinct_id",
            "age",
            "gender",
            F.date_format("month", "yyyyMM").alias("yyyymm"),
            F.explode(F.sequence(F.lit(1), copies)),
        )
        .drop("col")
    )


def people_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine without some rows: single months, people who are away for two years, who come late or who leave."""
    person, month = F.col("distinct_id"), F.col("yyyymm")
    number = F.substring("yyyymm", 1, 4).cast("int") * 12 + F.substring("yyyymm", 5, 2).cast("int")
    away = (
        ((person + number) % 7 == 0)
        | ((person % 11 == 3) & month.between(*AWAY))
        | ((person % 13 == 5) & (month < LATE))
        | ((person % 17 == 2) & (month > LEFT))
    )
    return people(spark, sf_dir).filter(~away)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with store, product, person and day.

    Lines are dealt out by their number before they meet their orders: what groups them behind the join, in the same
    tasks, takes memory by the line.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("distinct_id"),
        _day("o_orderdate", "yyyyMMdd").alias("yyyymmdd"),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )
    # counted from the footers of the files
    tasks = math.ceil(lines.count() / LINES_OF_TASK)
    lines = lines.repartition(tasks, "l_orderkey") if tasks > 1 else lines
    return (
        lines
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_quantity").cast("int").cast("string").alias("total_points"),
            F.when(F.col("l_returnflag") != "N", F.col("s_name")).alias("storename"),
            F.col("p_name").alias("productname"),
            "distinct_id",
            "yyyymmdd",
        )
    )


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("distinct_id"),
        _day("o_orderdate", "yyyy-MM-dd").alias("yyyymmdd"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "notification")
        .otherwise(F.lower("o_orderpriority"))
        .alias("main_event"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_custkey").alias("distinct_id"),
            _day("o_orderdate", "yyyyMMdd").alias("yyyymmdd"),
            F.when(F.col("o_orderstatus") != "P", F.col("r_name")).alias("region"),
        )
    )


def write_raw(
    spark: SparkSession, sf_dir: str, folder: str, id_column: Column | None = None, spine: Callable = people
) -> dict[str, str]:
    """The four raw tables written under ``folder``, three as Parquet and the events as CSV; gives their paths.

    ``id_column`` replaces the person id, ``spine`` makes the people.
    """
    made = {"people": spine, "points": points, "events": app_events, "visits": visits}
    paths = {name: f"{folder}/{name}" for name in made}
    for name, read in made.items():
        rows = read(spark, sf_dir)
        rows = rows if id_column is None else rows.withColumn("distinct_id", id_column)
        if name == "events":
            rows.write.option("header", True).csv(paths[name])
        else:
            rows.write.parquet(paths[name])
    return paths


def write_faulty(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    """As ``write_raw`` with ids as text and faults by the number of the order (of the person in the spine): no id, an
    id that is no number, no date, a date that is none, and, in the CSV file, lines that end before their last column."""
    paths = {name: f"{folder}/{name}" for name in ("people", "points", "events", "visits")}
    key = F.col("o_orderkey")
    person = F.col("o_custkey").cast("string")
    ids = F.when(key % 11 == 1, None).when(key % 11 == 2, F.concat(F.lit("x"), person)).otherwise(person)

    def dates(fmt: str) -> Column:
        return F.when(key % 13 == 3, None).when(key % 13 == 4, "2023-99").otherwise(_day("o_orderdate", fmt))

    orders = table(spark, sf_dir, "orders")
    rows = orders.select(ids.alias("distinct_id"), dates("yyyyMMdd").alias("yyyymmdd"), key.alias("key"))
    rows.select("distinct_id", "yyyymmdd", F.lit("ASIA").alias("region")).write.parquet(paths["visits"])
    rows.select(
        F.lit("3").alias("total_points"), F.lit("s").alias("storename"), F.lit("p").alias("productname"), "distinct_id", "yyyymmdd"
    ).write.parquet(paths["points"])
    line = F.concat_ws(",", F.coalesce(ids, F.lit("")), F.coalesce(dates("yyyy-MM-dd"), F.lit("")), F.lit("notification"))
    short = F.when(key % 17 == 5, F.coalesce(ids, F.lit("7"))).otherwise(line)
    # one column whose name is the whole header, so that lines are written as they are
    plain = orders.select(short.alias("distinct_id,yyyymmdd,main_event")).write.option("header", True)
    plain.option("sep", "\u0001").option("quote", "\u0000").csv(paths["events"])
    spine, n = people(spark, sf_dir), F.col("distinct_id")
    spine.select(
        F.when(n % 11 == 1, None).when(n % 11 == 2, F.concat(F.lit("x"), n.cast("string"))).otherwise(n.cast("string")).alias("distinct_id"),
        "age", "gender", F.when(n % 13 == 3, None).otherwise(F.col("yyyymm")).alias("yyyymm"),
    ).write.parquet(paths["people"])
    return paths


def month_span(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """First and last month of the orders."""
    key = F.date_format(F.col("o_orderdate").cast("date"), "yyyyMM")
    return tuple(table(spark, sf_dir, "orders").agg(F.min(key), F.max(key)).first())
