"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import dropped, written


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of every id in links (a, b): comp is the smallest id that links reach. Rounds go on until no label changes; labels only fall, so they end. Each round is written to the shared folder, so lineage stays short and a lost executor costs one round."""
    both = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "links")
    step = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("c")), "labels")
    while True:
        label = step.select("u", "c")
        near = both.join(label.select(F.col("u").alias("v"), F.col("c").alias("cv")), "v").groupBy("u").agg(F.min("cv").alias("m"))
        new = label.join(near, "u").select("u", F.col("c").alias("old"), F.least("c", "m").alias("c"))
        jump = label.select(F.col("u").alias("c"), F.col("c").alias("up"))
        new = written(new.join(jump, "c", "left").select("u", "old", F.least("c", "up").alias("c")), "labels")
        dropped(step)
        step = new
        if not step.filter("c < old").limit(1).count():
            dropped(both)
            out = step.select(F.col("u").alias("id"), F.col("c").alias("comp"))
            out._written_to = step._written_to  # for dropped()
            return out
