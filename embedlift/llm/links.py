"""Groups of linked items: candidate buckets to verified links to connected components.

No bucket is expanded into all its pairs. Each bucket is first compared with one centre, then with
about sixteen, and only those members are paired that are still in another component. So a bucket of
up to sixteen members has every pair compared or connected, and a bucket of copies of any size costs
about one comparison per member.

A larger bucket that is still in several components mostly holds ids that have nothing in common but
one frequent mark. It is dealt anew: its members meet again where they share a second such bucket,
then a third and a fourth, and in the last step with about ``MOST`` centres. A pair is left out only
if it shares no smaller bucket, fewer than two large ones, and neither id was a centre. So every
bucket costs a fixed number of pairs per member, whatever its size. Tables between rounds are
checkpoints in the shared folder; nothing is collected but counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from embedlift.workspace import checkpointed

#: How often members of large buckets are dealt anew, and centres of a bucket in the rounds of a deal.
DEPTHS = 3
CENTRES = (1, 16)
MOST = 256


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its smallest id) of every end of ``links`` (a, b).

    Alternates two steps until every id hangs on a root: all larger neighbours of an id move to
    its smallest neighbour, then its smaller neighbours and itself do.
    """
    both = checkpointed(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _are_stars(both):
        either = both.union(both.select("v", "u"))
        low = either.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = either.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        both = checkpointed(small.select("e.u", "e.v").where("u <> v").distinct())
    found = both.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.union(both.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """True if every id has one edge to a smaller one at most and no id has edges both ways."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


def linked(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``id`` and ``component`` of every id with a link.

    ``buckets`` has (bucket, id), the bucket a long, the id any sortable type. ``verify`` gets pairs
    (a, b), each once, and returns those that are links.
    """
    dealt = buckets.distinct()
    tried = groups = None
    for depth in range(1, DEPTHS + 1):
        sizes = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("smallest")).where("n > 1")
        levels = F.ceil(F.log2(F.col("n").cast("double"))).cast("int")
        level = F.length(F.regexp_extract(F.bin(F.xxhash64("id", "bucket")), "(0*)$", 1))
        members = checkpointed(dealt.join(sizes, "bucket").select("bucket", "id", "smallest", levels.alias("levels"), level.alias("level")))
        for few in CENTRES if depth < DEPTHS else (*CENTRES, MOST):
            now = _open(members, groups, few // 16)
            now = members.select("*", F.col("id").alias("component")) if now is None else checkpointed(now)
            is_centre = F.col("id") == F.col("smallest") if few == 1 else F.col("level") >= F.col("levels") - (few.bit_length() - 1)
            centres = now.where(is_centre).select("bucket", F.col("id").alias("centre"), F.col("component").alias("its"))
            pairs = (now.join(centres, "bucket").where("component <> its")
                     .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct())
            fresh = checkpointed(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
            if tried is not None and fresh.isEmpty():
                continue
            tried = fresh if tried is None else tried.union(fresh)
            found = checkpointed(verify(fresh))
            if groups is None:
                groups = components(found)
            elif not found.isEmpty():
                groups = components(groups.select(F.col("id").alias("a"), F.col("component").alias("b")).union(found))
        if depth < DEPTHS:
            left = checkpointed(_open(members, groups, CENTRES[-1]).select("bucket", "id"))
            other = left.select("id", F.col("bucket").alias("other"))
            dealt = left.join(other, "id").where("bucket < other").select(F.xxhash64("bucket", "other").alias("bucket"), "id")
            if dealt.isEmpty():
                break
    return groups


def _open(members: DataFrame, groups: DataFrame | None, compared: int) -> DataFrame | None:
    """Members, with their components, of buckets of more than ``compared`` that are not in one component."""
    if groups is None:
        return None
    now = members.where(F.col("levels") > (compared.bit_length() - 1 if compared else -1))
    now = now.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    unlike = now.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("bucket")
    return now.join(unlike, "bucket")
