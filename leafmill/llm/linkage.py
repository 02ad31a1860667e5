"""Classes of linked rows, from buckets that hold every pair that may be linked.

No bucket is ever compared with itself in full.  In each round a bucket has one leader, and only
members of another class than the leader's are compared with it; links merge classes at once, so a
bucket whose members are all alike is finished after one round.  The first leader is the member whose
buckets are fullest, as a rule the text that the others are copies of; later ones are random.  After a
few rounds, members of one bucket that are still in different classes and haven't been compared are
compared directly, also where no leader was like any member, and only in the smallest bucket that both
are in.  That loses no link: two members of a bucket end up in one class or have been found different.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import attach, only
from leafmill.scratch import settle

Verify = Callable[[DataFrame, DataFrame], DataFrame]
"""From candidate pairs (a, b), and the contents of their ids, to those pairs that are linked."""

ROUNDS = 3


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each end of a link (a, b) is connected to.

    Each step takes the smallest label among neighbours, then the label of that label, so paths
    shrink by half or more; all steps are joins of written tables.
    """
    both = settle(
        links.select(F.col("a").alias("id"), F.col("b").alias("to"))
        .union(links.select(F.col("b"), F.col("a")))
        .distinct(),
        "links",
    )
    labels = settle(
        both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("to"), "label"), "to")
            .groupBy("id")
            .agg(F.min("label").alias("near"))
        )
        step = settle(
            labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old")),
            "step",
        )
        up = step.select(F.col("id").alias("label"), F.col("label").alias("up"))
        jumped = settle(
            step.join(up, "label").select("id", F.col("up").alias("label"), (F.col("up") != F.col("old")).alias("moved")),
            "jumped",
        )
        labels = jumped.select("id", "label")
        if jumped.where("moved").isEmpty():
            return labels


def shared(members: DataFrame) -> DataFrame:
    """Those (bucket, id), once each, whose bucket has another id."""
    ends = members.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    open_ = settle(ends.where("low < high").select("bucket"), "open")
    return settle(only(members, open_, "bucket").distinct(), "shared")


def fullness(rows: DataFrame, total: int) -> DataFrame:
    """(id, full): how many members the buckets of an id have, taken together."""
    sizes = settle(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")), "sizes")
    sized = attach(rows, sizes, ["bucket"], "size", total)
    return sized.groupBy("id").agg(F.sum("size").alias("full"))


def classes(
    members: DataFrame,
    contents: Callable[[DataFrame], DataFrame],
    may: Callable[[Column, Column], Column],
    verify: Verify,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(id, label) of all ids that are linked to another, from ``members`` (bucket, id).

    ``contents`` gives what is compared, for written ids (id) that share a bucket: a table with id and
    sketch, a few bytes.  ``may`` is a condition on two sketches that every link fulfils; pairs that
    don't are never made.  ``label`` is the smallest id of the class.
    """
    rows = shared(members)
    total = rows.count()
    if not total:
        return rows.select("id", F.col("id").alias("label"))
    held = contents(settle(rows.select("id").distinct(), "candidates"))
    rows = settle(rows.join(held.select("id", "sketch").join(fullness(rows, total), "id"), "id"), "sketched")
    labels: DataFrame | None = None
    links: DataFrame | None = None
    tested: DataFrame | None = None

    for turn in range(rounds + 1):
        now = rows.withColumn("label", F.col("id"))
        if labels is not None:
            now = settle(
                rows.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")), "labelled"
            )
        if turn < rounds:
            first = F.lit(0) if turn else -F.col("full")
            lead = F.min(F.struct(first, F.xxhash64("id", F.lit(turn)), "id", "label", "sketch")).alias("lead")
            heads = settle(
                now.groupBy("bucket")
                .agg(lead, F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("size"))
                .where("low != high")
                .select(
                    "bucket", "size", F.col("lead.id").alias("head"), F.col("lead.label").alias("of"),
                    F.col("lead.sketch").alias("other"),
                ),
                "heads",
            )
            near = (F.col("label") != F.col("of")) & may(F.col("sketch"), F.col("other"))
            met = attach(now, heads, ["bucket"], "size", total).where(near).select("id", "head")
        else:
            # what the rounds have left: pairs of one bucket in different classes
            left = settle(
                now.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("bucket"),
                "left",
            )
            open_ = settle(now.join(left, "bucket"), "rest")
            own = open_.groupBy("id").agg(F.sort_array(F.collect_set("bucket")).alias("mine"))
            rest = settle(open_.join(own, "id"), "within").alias("x")
            other = rest.select(
                "bucket", F.col("id").alias("head"), F.col("label").alias("of"), F.col("sketch").alias("other"), F.col("mine").alias("its")
            ).alias("y")
            near = (
                (F.col("x.bucket") == F.col("y.bucket"))
                & (F.col("label") < F.col("of"))
                & may(F.col("x.sketch"), F.col("other"))
                & (F.get(F.array_intersect("mine", "its"), F.lit(0)) == F.col("x.bucket"))
            )
            met = rest.join(other, near).select("id", "head")
        pairs = met.select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = settle(pairs, "pairs")
        if pairs.isEmpty():  # this leader is unlike the others, which may yet be alike
            continue
        tested = pairs if tested is None else tested.union(pairs)
        found = settle(verify(pairs, held), "found")
        links = found if links is None else links.union(found)
        if not found.isEmpty():
            labels = components(links)
    if labels is None:
        return rows.select("id", F.col("id").alias("label")).limit(0)
    return labels
