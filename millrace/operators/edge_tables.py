"""Edges prepared once and read by many jobs: bucketed and sorted by source."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.graph import EdgeStore
from millrace.operators.skew import BLOCK_ROWS, KeyProfile, block_of, profile_key, with_blocks

_EDGES = "src bigint, block int, dst bigint, copies bigint"
_HOT = "src bigint, blocks int"
_SHAPE = "edge_rows bigint, buckets int, block_rows bigint"


def save_edge_table(edges: DataFrame, folder: str, buckets: int | None = None, block_rows: int = BLOCK_ROWS) -> None:
    """Write distinct edges with their number of copies below `folder`, bucketed and
    sorted by source and block, for `open_edge_table`. Edges without a destination
    are left out.

    A source of more than a block of edges lies in several buckets. A job joins its
    frontiers with the buckets; the edges are not shuffled again, in no session.
    """
    spark = edges.sparkSession
    counted = (
        edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
        .groupBy(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    profile = profile_key(counted, "src", block_rows)
    buckets = buckets or profile.partitions
    name = f"edges_{uuid.uuid4().hex}"
    (
        with_blocks(counted, "src", profile)
        .select("src", block_of("dst").alias("block"), "dst", "copies")
        .repartition(buckets, "src", "block")
        .write.bucketBy(buckets, "src", "block")
        .sortBy("src", "block")
        .option("path", f"{folder}/edges")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # the files stay
    spark.createDataFrame(list(profile.hot), _HOT).write.parquet(f"{folder}/hot")
    spark.createDataFrame([(profile.rows, buckets, profile.block_rows)], _SHAPE).write.parquet(f"{folder}/shape")


def open_edge_table(spark: SparkSession, folder: str) -> EdgeStore:
    """The edges saved in `folder`, for traversals and frontier joins of any session."""
    shape = spark.read.schema(_SHAPE).parquet(f"{folder}/shape").first()
    hot = spark.read.schema(_HOT).parquet(f"{folder}/hot").collect()  # 4 keys per bucket at most
    name = f"edges_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({_EDGES}) USING parquet LOCATION '{folder}/edges' "
        f"CLUSTERED BY (src, block) SORTED BY (src, block) INTO {shape.buckets} BUCKETS"
    )
    profile = KeyProfile(shape.edge_rows, shape.buckets, shape.block_rows, tuple((r.src, r.blocks) for r in hot))
    return EdgeStore(spark.table(name), profile, by_block=True)


def reversed_edges(store: EdgeStore) -> DataFrame:
    """The stored edges (src, dst) turned round, once for each copy."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return store.edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), copies).drop("col")
