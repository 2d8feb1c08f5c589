"""Helpers shared by the training-data operators.

Conventions: an operator selects the columns it needs by name, so extra columns
(whatever their names) never reach its joins; a null text counts as the empty
text unless an operator says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import join_dimension
from ..sources.shared import materialise, shared_dir  # noqa: F401 - for the operators


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test-data table; read by Spark only, so any path Spark knows works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame) -> DataFrame:
    """Distributed union-find over an edge table (a, b): (node, component).

    Alternates the large-star and small-star steps, each one grouped minimum
    (combined map-side) and one join on the node, until the edges form stars.
    ``component`` is the smallest node of the component.  Nodes that have no edge
    to another node are not returned.  Rounds grow with the logarithm of the
    longest chain; each ends in a table in the shared folder.
    """
    stars = materialise(edges.filter("a <> b").selectExpr("greatest(a, b) AS hi", "least(a, b) AS lo"), "edges")
    while _open(stars):
        both = stars.selectExpr("hi AS u", "lo AS v").union(stars.selectExpr("lo AS u", "hi AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        # a hot root's edges may be split between tasks in both joins
        large = join_dimension(both, least, "u").filter("v > u").selectExpr("v AS hi", "m AS lo")
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = join_dimension(large, root, "hi").filter("lo <> m").selectExpr("lo AS hi", "m AS lo").union(root.selectExpr("hi", "m AS lo"))
        stars = materialise(small.distinct(), "stars")
    return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
        stars.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()


def _open(stars: DataFrame) -> bool:
    """Whether some node has two smaller neighbours, or both a smaller and a larger one."""
    ends = stars.selectExpr("hi AS node", "lo AS low", "false AS root").union(
        stars.selectExpr("lo AS node", "CAST(NULL AS " + stars.schema["lo"].dataType.simpleString() + ") AS low", "true AS root"))
    seen = ends.groupBy("node").agg(F.min("low").alias("least"), F.max("low").alias("most"), F.max("root").alias("root"))
    return bool(seen.filter("least <> most OR (least IS NOT NULL AND root)").limit(1).count())
