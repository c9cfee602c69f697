"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(v, c) for every vertex of the links: c is the least vertex reachable.

    Least labels spread along the links and jump to the label of the label, so that the rounds grow
    with the logarithm of the longest chain. Every round is written to the shared folder. Links may
    repeat and join a vertex with itself; a vertex with very many links is a key of joins that can be
    split and of aggregations that combine first.
    """
    both = stored(
        links.select(F.col(a).alias("x"), F.col(b).alias("y"))
        .union(links.select(F.col(b), F.col(a))).filter("x is not null and y is not null").distinct(),
        "links")
    labels = stored(both.groupBy(F.col("x").alias("v")).agg(
        F.least(F.min("y"), F.first("x")).alias("c")), "labels")
    while True:
        far = labels.select(F.col("v").alias("y"), F.col("c").alias("cy"))
        offers = (
            both.join(far, "y").groupBy("x").agg(F.min("cy").alias("near"))
            .select(F.col("x").alias("v"), "near"))
        nearer = labels.join(offers, "v", "left").select(
            "v", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("cc"))
        following = stored(
            nearer.join(jump, "c", "left").select("v", "old", F.least("c", F.coalesce("cc", "c")).alias("c")),
            "labels")
        changed = following.filter("c < old").limit(1).count()
        labels = following.select("v", "c")
        if not changed:
            return labels
