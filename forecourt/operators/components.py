"""Connected components by alternating large-star and small-star steps.

Every step is a minimum for each node (combined before the shuffle) and an
equi-join back, so a hub's edges are never gathered in one place, and the
number of rounds grows with the logarithm of a component's size, without a
limit.  The edges of a round are written to the shared scratch folder, which
cuts the lineage; the table of the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.session import drop_scratch, write_scratch
from forecourt.sources import generations


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbourhood."""
    both = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = e.groupBy("hi").agg(F.min("lo").alias("m"))
    lower = e.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return lower.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def star_forest(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) for every node of ``edges`` (columns src, dst) that is not
    the smallest of its component; the smallest is the component.  Self-loops
    and edges with a null end are no links."""
    spark = edges.sparkSession
    e = (edges.where("src <> dst")
         .select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")).distinct())
    path, before = write_scratch(e, name), None
    while True:
        now = spark.read.parquet(path)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
        before = state
        newer = write_scratch(_small_star(_large_star(now)), name)
        drop_scratch(spark, path)
        path = newer


# ------------------------------------------------------- a stored forest
BUCKETS = 64


def merge_links(links: DataFrame, store: str, batch: int, buckets: int = BUCKETS) -> None:
    """Add a batch of links (src, dst) to a stored forest of components.

    Both ends are replaced by the roots of their stored components, so the steps run on
    links between roots only; the members of roots that lost theirs to a smaller one
    are relabelled, and only the buckets of those components are rewritten.  What happened to
    each root is kept in the store's history.  The result after any batches equals
    ``star_forest`` of all links; a batch that is applied twice changes nothing.
    """
    spark = links.sparkSession
    forest = generations.read(spark, f"{store}/forest", "bucket")
    ends = links.where("src <> dst").select("src", "dst").distinct()
    if forest is not None:
        for end in ("src", "dst"):
            roots = forest.select(F.col("id").alias(end), F.col("component").alias("_root"))
            ends = ends.join(roots, end, "left").withColumn(end, F.coalesce("_root", end)).drop("_root")
    moved = spark.read.parquet(write_scratch(star_forest(ends), "components-moved"))
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    touched = moved.select(F.explode(F.array(bucket("id"), bucket("component"))).alias("b")).distinct()
    touched = [r[0] for r in touched.collect()]  # at most ``buckets``
    if not touched:
        return
    moved.select("id", F.col("component").alias("merged_into")).write.mode("overwrite").parquet(f"{store}/history/batch={batch}")
    rows, old = moved.select("id", "component"), generations.read(spark, f"{store}/forest", "bucket", touched)
    if old is not None:
        new = moved.select(F.col("id").alias("component"), F.col("component").alias("_new"))
        rows = rows.unionByName(old.join(new, "component", "left").select("id", F.coalesce("_new", "component").alias("component")))
    generations.replace(spark, f"{store}/forest", rows.withColumn("bucket", bucket("component")).repartition("bucket", bucket("id") % 4),
                        "bucket", touched)


def stored_forest(spark: SparkSession, store: str) -> DataFrame | None:
    """(id, component) as ``star_forest`` gives it; None before the first link."""
    forest = generations.read(spark, f"{store}/forest", "bucket")
    return None if forest is None else forest.select("id", "component")


def root_history(spark: SparkSession, store: str) -> DataFrame:
    """(id, merged_into, batch): the root that each id lost its place to, by batch."""
    return spark.read.parquet(f"{store}/history")
