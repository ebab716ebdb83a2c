"""Mixing sources to target shares by weighted fair queueing.

Every use of a document gets a virtual finish time: the tokens of its source up to and with it, in shuffled order, divided by
the source's share. Uses in the order of finish times are the mix; it ends at the total budget. Running sums are made in two
levels (sums of hash buckets, then inside a bucket), so that neither a source nor the whole mix is ever in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvarto.session import bounded_rows, checkpointed


def running(df: DataFrame, groups: list[str], key: Column, buckets: int, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds the running sum of `value` in each group; `key` is a number in [0, 1) that the order follows."""
    cut = df.withColumn("bucket__", F.least(F.floor(key * buckets), F.lit(buckets - 1)))
    sums = cut.groupBy(*groups, "bucket__").agg(F.sum(value).alias("sum__"))
    earlier = Window.partitionBy(*groups).orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before__", F.coalesce(F.sum("sum__").over(earlier), F.lit(0))).drop("sum__")
    inside = Window.partitionBy(*groups, "bucket__").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.withColumn("in__", F.sum(value).over(inside)).join(sums, [*groups, "bucket__"]).withColumn(name, F.col("before__") + F.col("in__")).drop("bucket__", "in__", "before__")


def uses(docs: DataFrame, targets: DataFrame, seed: int = 7, bucket_rows: int = 100_000, limit_sources: int = 100_000, budget: int | None = None) -> tuple[DataFrame, int, int]:
    """The uses (id, source, tokens, use, finish) of documents (id, source, tokens) that a mix of `budget` tokens (all by default) can reach, all tokens of targeted sources, and how many uses there are.

    When the mix ends follows from the totals alone: up to the virtual time t a source has given least(share * t, max_uses *
    its tokens); the t at which the sum is the budget is the horizon, and rounds of uses that begin after it are not made.

    targets is (source, target_share, max_uses). The shuffled order differs from use to use. Other columns of docs are ignored; null sizes count as 0.
    """
    plan = bounded_rows(targets.filter("source IS NOT NULL").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_uses").alias("max_uses")), limit_sources)
    if plan is None:
        raise ValueError(f"more than {limit_sources} sources to mix")
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(r["source"], float(r["target_share"] or 0), int(r["max_uses"] or 0)) for r in plan], "source string, share double, max_uses int"))
    own = docs.select("id", "source", F.coalesce("tokens", F.lit(0)).alias("tokens")).join(wanted, "source")
    totals = own.groupBy("source").agg(F.sum("tokens").alias("source_tokens"), F.count("*").alias("n")).collect()  # at most one row for each source
    total, rows = sum(r["source_tokens"] or 0 for r in totals), sum(r["n"] for r in totals)
    supply = {r["source"]: (float(r["target_share"] or 0), int(r["max_uses"] or 0)) for r in plan}
    given = [(*supply[r["source"]], int(r["source_tokens"] or 0)) for r in totals]
    ends = max(horizon(given, total), float(total)) if budget is None else horizon(given, budget)
    rounds = {r["source"]: max(0, min(most, math.ceil(ends * share / max(1, tokens)) + 1)) for r, (share, most, tokens) in zip(totals, given)}
    sizes = F.broadcast(spark.createDataFrame([(r["source"], tokens, rounds[r["source"]]) for r, (_, _, tokens) in zip(totals, given)], "source string, source_tokens long, rounds int"))
    each = own.filter("share > 0 AND max_uses > 0").join(sizes, "source").withColumn("use", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), "rounds"))))
    each = each.withColumn("hash", F.xxhash64("id", "use", F.lit(seed)))
    place = F.shiftrightunsigned("hash", 11) / F.lit(float(1 << 53))
    summed = running(each, ["source", "use"], place, max(1, -(-rows // bucket_rows)), [place, F.col("hash"), F.col("id")], "tokens", "so_far")
    finish = (F.col("so_far") + (F.col("use") - 1) * F.col("source_tokens")) / F.col("share")
    return summed.select("id", "source", "tokens", "use", "hash", finish.alias("finish")), total, sum(r["n"] * max(1, rounds[r["source"]]) for r in totals)


def horizon(sources: list[tuple[float, int, int]], budget: int) -> float:
    """The virtual time at which sources (share, max_uses, tokens) have given the budget, the greatest last finish time if they can't."""
    sources = sorted((most * tokens / share, share, most * tokens) for share, most, tokens in sources if share > 0 and most > 0 and tokens > 0)
    given, rate = 0.0, sum(share for _, share, _ in sources)
    for end, share, most in sources:
        if rate > 0 and (at := (budget - given) / rate) <= end:
            return max(at, 0.0)
        given, rate = given + most, rate - share
    return sources[-1][0] if sources else 0.0


def mix(docs: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 7, bucket_rows: int = 100_000) -> DataFrame:
    """The uses (id, source, tokens, use, finish) that make up the mix, in finish order up to the budget (all targeted tokens by default).

    Cases: sources not in the targets, and null ones, take no part; targets without documents yield nothing; null sizes
    count as 0; equal finish times are ordered by hash and id; the use that would pass the budget ends the mix.
    """
    every, total, made = uses(docs, targets, seed, bucket_rows, budget=budget)
    budget = total if budget is None else budget
    # exact place in the whole order: a global range sort, then running sums over its ranges
    ranges = max(1, -(-made // bucket_rows) * 4)
    placed = checkpointed(every.repartitionByRange(ranges, "finish", "hash", "id", "use").withColumn("range__", F.spark_partition_id()))
    sums = placed.groupBy("range__").agg(F.sum("tokens").alias("sum__"))
    sums = sums.withColumn("before__", F.coalesce(F.sum("sum__").over(Window.orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("sum__")  # one row for each range
    inside = Window.partitionBy("range__").orderBy("finish", "hash", "id", "use").rowsBetween(Window.unboundedPreceding, 0)
    mixed = placed.withColumn("in__", F.sum("tokens").over(inside)).join(sums, "range__")
    return mixed.filter(F.col("before__") + F.col("in__") <= budget).select("id", "source", "tokens", "use", "finish")


def supply_report(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, last_finish, short): `short` sources have used up all they may give before the budget's virtual time; a target of nothing is always reached."""
    every, total, _ = uses(docs, targets)
    last = every.groupBy("source").agg(F.max("finish").alias("last_finish"))
    return targets.select("source", "target_share").join(last, "source", "left").withColumn("short", (F.col("target_share") > 0) & (F.coalesce(F.col("last_finish"), F.lit(0.0)) < F.lit(float(total))))


def mix_report(docs: DataFrame, targets: DataFrame, budget: int | None = None) -> DataFrame:
    """(source, target_share, uses, tokens, actual_share) of the mix, for every target."""
    mixed = mix(docs, targets, budget).groupBy("source").agg(F.count("*").alias("uses"), F.sum("tokens").alias("tokens"))
    joined = targets.select("source", "target_share").join(mixed, "source", "left").na.fill({"uses": 0, "tokens": 0})
    return joined.withColumn("actual_share", F.col("tokens") / F.sum("tokens").over(Window.partitionBy()))
