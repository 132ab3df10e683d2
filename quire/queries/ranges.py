"""Range joins over the data tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import intervals

DAY, MINUTE = 86_400_000_000, 60_000_000


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros(name: str):
    return F.unix_micros(F.col(name).cast("timestamp"))


def orders_meanwhile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: how many orders its customer placed from its day until its last line was shipped, itself included, and their price."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", _micros("o_orderdate").alias("at"))
    shipped = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(_micros("l_shipdate")).alias("high"))
    spans = orders.join(shipped, "o_orderkey").select(F.col("o_orderkey").alias("order"), "o_custkey", F.col("at").alias("low"), "high")
    met = intervals.within(orders, spans, 60 * DAY, ["o_custkey"])
    return met.groupBy("order").agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))


def events_after_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per error and type: how many events of that type any user had in the ten minutes from it on."""
    events = _t(spark, sf_dir, "events").select("event_id", "event_type", _micros("ts").alias("at"))
    spans = events.where("event_type = 'error'").select(F.col("event_id").alias("error"), F.col("at").alias("low"), (F.col("at") + 10 * MINUTE).alias("high"))
    return intervals.within(events, spans, 10 * MINUTE).groupBy("error", "event_type").agg(F.count("*").alias("n"))


SQL = {
    "orders_meanwhile": "WITH s AS (SELECT l_orderkey, max(l_shipdate) AS high FROM lineitem GROUP BY l_orderkey), m AS (SELECT o_orderkey AS \"order\", o_custkey AS c, o_orderdate AS low, high FROM orders JOIN s ON o_orderkey = l_orderkey) SELECT \"order\", count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM m JOIN orders o ON o.o_custkey = m.c AND o.o_orderdate BETWEEN m.low AND m.high GROUP BY \"order\"",
    "events_after_errors": "SELECT e.event_id AS error, p.event_type, count(*) AS n FROM events e JOIN events p ON p.ts BETWEEN e.ts AND e.ts + INTERVAL 10 MINUTE WHERE e.event_type = 'error' GROUP BY ALL",
}

QUERIES = {f.__name__: f for f in (orders_meanwhile, events_after_errors)}
