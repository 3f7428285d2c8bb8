"""Connected components by label spreading with pointer jumping; every round is joins and sums on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import stage


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root: the smallest node reachable over links (a, b), for all nodes that have links.

    Each round every node takes the smallest label around it, then its label's label; a path of n nodes is
    done after about log n rounds. Labels are written to the shared folder each round. Self links are
    allowed; links with nulls are ignored. Raises if `rounds` do not suffice.
    """
    links = links.filter("a is not null and b is not null")
    ways = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stage(ways.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "labels")
    for _ in range(rounds):
        around = ways.join(labels, F.col("b") == F.col("node")).select(F.col("a").alias("node"), "root")
        # A node's root also learns what the node learns, so whole trees hook on at once.
        own = labels.select(F.col("node"), F.col("root"))
        low = around.unionByName(own).groupBy("node").agg(F.min("root").alias("low"))
        hook = low.join(labels.select(F.col("node").alias("n"), "root"), F.col("node") == F.col("n")).select(F.explode(F.array(F.struct(F.col("node").alias("node"), F.col("low").alias("low")), F.struct(F.col("root").alias("node"), F.col("low").alias("low")))).alias("x")).select("x.node", "x.low")
        low = hook.groupBy("node").agg(F.min("low").alias("low"))
        jump = low.select(F.col("node").alias("j_node"), F.col("low").alias("j_low"))
        new = stage(low.join(jump, F.col("low") == F.col("j_node"), "left").select("node", F.least("low", F.coalesce("j_low", "low")).alias("root")), "labels")
        changed = new.join(labels.select(F.col("node").alias("n"), F.col("root").alias("was")), F.col("node") == F.col("n")).filter("root <> was").limit(1).count()
        labels = new
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
