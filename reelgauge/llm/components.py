"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node that has an edge.

    Rounds of two steps until nothing changes: each node takes the least label among its own and
    its neighbours', then the label of its label. The second step halves the way to the least node,
    so the number of rounds grows with the logarithm of a component's diameter. Every round is
    written to the shared folder. Null ends are left out; repeated edges and loops do no harm.
    """
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    both = stored(
        known.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .unionByName(known.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct(),
        "edges",
    )
    least = F.min("other").alias("least")
    labels = stored(
        both.groupBy("node").agg(least).select("node", F.least("node", "least").alias("label")),
        "labels",
    )
    while True:
        own = labels.select(F.col("node").alias("other"), "label")
        heard = both.join(own, "other").groupBy("node").agg(F.min("label").alias("heard"))
        told = labels.join(heard, "node", "left").select(
            "node", "label", F.least("label", "heard").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("further"))
        moved = stored(
            told.join(jump, "next", "left").select(
                "node", F.least("next", "further").alias("label"),
                (F.least("next", "further") < F.col("label")).alias("changed"),
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if not moved.where("changed").limit(1).count():
            return labels
