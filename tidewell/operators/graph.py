"""Connected groups over a relation of members and shared keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize


def member_components(edges: DataFrame, member: str, key: str) -> DataFrame:
    """(member, component): members that share a key, directly or over others, carry the smallest member id.

    Every round hands the smallest label of a key to all its members and of a member to all its keys, then
    follows labels of labels, which halves long chains. Minima are combined on the map side, so a key shared by
    a third of all members sends one row per task. Pairs of members are never formed. Labels are written once a
    round to the shared folder, so a lost executor repeats one round at most. The loop ends when no label
    changes, which it must, as each round lowers a label; the driver only sees the number of changes.
    """
    links = materialize(edges.select(F.col(member).alias("m"), F.col(key).alias("k")).where("m IS NOT NULL AND k IS NOT NULL").distinct(), "links")
    labels = materialize(links.select("m").distinct().withColumn("label", F.col("m")), "labels")
    while True:
        per_key = links.join(labels, "m").groupBy("k").agg(F.min("label").alias("label"))
        hopped = links.join(per_key, "k").groupBy("m").agg(F.min("label").alias("hop"))
        jump = labels.select(F.col("m").alias("hop"), F.col("label").alias("far"))
        stepped = labels.join(hopped, "m").join(jump, "hop").select("m", "label", F.least("label", "hop", "far").alias("fresh"))
        stepped = materialize(stepped, "labels")
        changed = stepped.where("fresh <> label").count()
        labels = stepped.select("m", F.col("fresh").alias("label"))
        if changed == 0:
            return labels.select(F.col("m").alias(member), F.col("label").alias("component"))


def contracted_components(edges: DataFrame, member: str, key: str, trace: list[int] | None = None) -> DataFrame:
    """(member, component): the result of `member_components`, by contraction - a round only reads edges that are still open.

    Keys become stars: each of a key's members points to the smallest. Rounds then alternate between two steps over edges from a larger to a smaller
    member: every member hands its smallest neighbour to its larger neighbours, then to its smaller ones. Both keep
    components and pull them towards their smallest member. A member with one edge left, and to which none points, is settled: its edge
    moves to a list of its own and is not read again. When no edge is open, labels follow from the lists, last one first.

    Minima are combined on the map side, so a member of many edges is no large group; joins with a hot member are split at run time. Edges
    are written once a round, so a lost executor repeats one round at most. `trace` gets the number of open edges of each round. NULL members and
    keys link nothing; members without a key stay out, as do empty tables.
    """
    links = materialize(edges.select(F.col(member).alias("m"), F.col(key).alias("k")).where("m IS NOT NULL AND k IS NOT NULL").distinct(), "links")
    least = links.groupBy("k").agg(F.min("m").alias("p"))
    pending = materialize(links.join(least, "k").where("m <> p").select(F.col("m").alias("c"), "p").distinct(), "open-edges")
    settled = []
    while (n := pending.count()) > 0:
        if trace is not None:
            trace.append(n)
        pointed = pending.select(F.col("p").alias("c")).distinct()
        alone = pending.groupBy("c").agg(F.min("p").alias("p"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n").join(pointed, "c", "left_anti")
        alone = materialize(alone, "settled-edges")
        settled.append(alone)
        rest = pending.join(alone.select("c"), "c", "left_anti")
        both = rest.unionAll(rest.select(F.col("p").alias("c"), F.col("c").alias("p")))
        far = both.groupBy("c").agg(F.min("p").alias("low")).select("c", F.least("c", "low").alias("low"))
        larger = rest.select(F.col("p").alias("c"), F.col("c").alias("v")).join(far, "c").select(F.col("v").alias("c"), F.col("low").alias("p")).where("c <> p").distinct()
        near = larger.groupBy("c").agg(F.min("p").alias("low"))
        smaller = larger.join(near, "c").select(F.col("p").alias("c"), F.col("low").alias("p")).where("c <> p")
        pending = materialize(smaller.unionAll(near.select("c", F.col("low").alias("p"))).distinct(), "open-edges")
    labels = None
    for level in reversed(settled):
        if labels is None:
            labels = level.select("c", F.col("p").alias("label"))
        else:
            onward = labels.select(F.col("c").alias("p"), F.col("label").alias("onward"))
            found = level.join(onward, "p", "left").select("c", F.coalesce("onward", "p").alias("label"))
            labels = materialize(labels.unionAll(found), "labels")
    members = links.select("m").distinct()
    if labels is None:
        return members.select(F.col("m").alias(member), F.col("m").alias("component"))
    named = members.join(labels, members["m"] == labels["c"], "left")
    return named.select(F.col("m").alias(member), F.coalesce("label", "m").alias("component"))
