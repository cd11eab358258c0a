"""Connected components of a link table by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import drop_scratch, write_scratch

MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """Written table (node, root): root is the smallest node reachable from node.

    ``links`` has columns a and b, in any direction. Each round takes the smallest label
    among a node's neighbours and then the label of that label, so a chain of n links needs
    about log n rounds. Labels are written each round; nothing but a count reaches the driver.
    """
    both = write_scratch(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                         .where("a <> b").distinct(), "links")
    label = write_scratch(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                          .select("node", F.least("node", "m").alias("root")), "labels")
    for _ in range(MAX_ROUNDS):
        near = (both.join(label, both.b == label.node).groupBy(F.col("a").alias("x")).agg(F.min("root").alias("m")))
        step = write_scratch(label.join(near, label.node == near.x)
                             .select("node", "root", F.least("root", "m").alias("low")), "step")
        up = step.select(F.col("node").alias("x"), F.col("low").alias("up"))
        nxt = write_scratch(step.join(up, step.low == up.x)
                            .select("node", F.col("root").alias("was"), F.least("low", "up").alias("root")), "labels")
        drop_scratch(step)
        drop_scratch(label)
        label = nxt
        if label.where("root <> was").isEmpty():
            drop_scratch(both)
            return label.select("node", "root")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
