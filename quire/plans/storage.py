"""Results that later steps read more than once."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that a side of a join is broadcast with at most; beyond, the join shuffles or goes block by block.
BROADCAST_ROWS = 100_000
#: Bytes that its columns of any length may hold together.
BROADCAST_BYTES = 64 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below spark.checkpoint.dir. Where the session names none, a local session gets a temporary one; a
    cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[\d*, ]+\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quire-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/quire-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df written to a shared folder and read back, so that nothing before it runs again, also if executors are lost."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hinted(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df for the small side of a join: broadcast if it is counted to have so few rows and so few bytes, else left to shuffle."""
    size = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind == "array<string>":
            size = size + F.coalesce(F.octet_length(F.array_join(c, " ")), F.lit(0))
        elif kind.startswith(("array", "map")):
            size = size + 64 * F.coalesce(F.size(c), F.lit(0))
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= most and held <= BROADCAST_BYTES else df


def ranked(rows: DataFrame, order: list[str], name: str = "k") -> DataFrame:
    """rows with their number from 0 in order. Ranges of rows are sorted side by side and shifted by the rows before them, so
    no task holds more than a range."""
    parts = settled(rows.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = parts.groupBy("__part").agg(F.count("*").alias("__size"))
    # One row for each range: few, whatever the number of rows.
    before = sizes.select("__part", F.coalesce(F.sum("__size").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    within = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    return parts.withColumn(name, within).join(F.broadcast(before), "__part").withColumn(name, F.col(name) + F.col("__before")).drop("__part", "__before")


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of the ends of edges (a, b): root is the least id that edges lead to.

    Nodes hang on the least of their neighbourhood, larger neighbours and smaller ones in turn, so a chain halves in every
    round instead of passing one label along; each round is settled, and a hub costs a row for each neighbour.
    """
    edges = settled(edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct())
    nodes, links, seen = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct(), edges.where("a <> b"), None
    while True:
        near = links.union(links.select("b", "a"))
        top = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        up = near.where("b > a").join(top, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = settled(down.where("a <> b").distinct())
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return nodes.join(links.select(F.col("a").alias("id"), F.col("b").alias("root")), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
        seen = state
