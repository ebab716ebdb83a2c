"""Differences between two copies of a keyed dataset by hierarchical checksums.

The rows of both sides, reduced to digests, are moved once: to the partition of their top range of key positions. All that
follows happens there. First each side picks the newest digest of each of its keys. Then each side has one checksum for a
range, the xor of its digests, with their number; ranges in which the two agree are dropped, the others are halved and looked
at again, down to leaves of a few keys. Only in the remaining leaves are keys of the two sides brought together and fields
compared.

How many positions a top range holds follows from the number and the spread of the keys, so that keys of any kind (hashes of
texts too) lie some thousand to a range. A key with very many rows is found beforehand by a sketch of fixed size and
reduced to its newest digest before it is moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def field_hash(col: Column, dtype: T.DataType) -> Column:
    """64-bit hash of a field; null stays null, so that null equals only null. Numbers of 8 bytes or fewer stay as they are."""
    if isinstance(dtype, (*_INTEGRAL, T.BooleanType, T.DateType, T.TimestampType, T.DoubleType, T.FloatType)):
        return col
    if isinstance(dtype, T.MapType):
        col = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(col))))
    return F.when(col.isNotNull(), F.xxhash64(col))


def _digests(df: DataFrame, keys: Sequence[str], version: str | None, fields: Sequence[str], side: str) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    hashes = [field_hash(F.col(f"`{f}`"), types[f]).alias(f"f{i}") for i, f in enumerate(fields)]
    order = [F.col(f"`{version}`").alias("version")] if version else []
    return df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], F.lit(side).alias("side"), F.struct(*order, *hashes).alias("digest"))


def _position(keys: Sequence[str], dtype: T.DataType) -> Column:
    """The place of a key in the range tree: an integral key itself, else its hash."""
    if len(keys) == 1 and isinstance(dtype, _INTEGRAL):
        return F.col("k0").cast("long")
    return F.xxhash64(*[F.coalesce(F.col(f"k{i}").cast("string"), F.lit("\x00")) for i in range(len(keys))])


def _layout(sides: DataFrame, per_range: int, hot_share: float) -> tuple[int, list[int]]:
    """(bits of a top range, positions of keys with more than `hot_share` of all rows), from the key columns alone.

    The sketch counts at most 10,000 positions at a time; no key with a hundredth of a percent of the rows escapes it.
    """
    sketch = F.expr("approx_top_k(position, 1000, 10000)")
    r = sides.agg(F.count("*").alias("n"), F.min("position").alias("lo"), F.max("position").alias("hi"), sketch.alias("top")).first()
    if not r["n"]:
        return 0, []
    # as many positions to a range as hold `per_range` rows if they lie evenly
    spread = (r["hi"] - r["lo"] + 1) * per_range // r["n"]
    return min(63, max(spread, per_range).bit_length() - 1), [x["item"] for x in r["top"] if x["count"] > max(hot_share * r["n"], per_range)]


def mismatched_leaves(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str], version: str | None = None, per_range: int = 4096, leaf_keys: int = 4, hot_share: float = 0.001) -> DataFrame:
    """Keys of the leaf ranges in which the two sides differ, with both digests (k0.., l, r).

    Top ranges hold about `per_range` rows, leaves a range of positions that is smaller by per_range / leaf_keys. `version`
    names the column whose greatest value picks the row that counts for a key; null versions rank below all others and ties
    go to the greatest digest, on both sides alike.
    """
    types = {f.name: f.dataType for f in left.schema.fields}
    names = [f"k{i}" for i in range(len(keys))]
    both = _digests(left, keys, version, fields, "l").unionByName(_digests(right, keys, version, fields, "r")).withColumn("position", _position(keys, types[keys[0]]))
    top, hot = _layout(both.select(F.coalesce("position", F.lit(0)).alias("position")), per_range, hot_share)
    levels = list(range(top, max(0, top - (per_range // leaf_keys).bit_length() + 1) - 1, -1))
    if hot:
        often = F.coalesce(F.col("position").isin(hot), F.lit(False))
        few = both.filter(often).groupBy(*names, "side", "position").agg(F.max("digest").alias("digest"))
        both = both.filter(~often).unionByName(few.select(*both.columns))
    placed = both.withColumn(f"range{top}", F.shiftright("position", top)).repartition(f"range{top}").withColumns({f"range{b}": F.shiftright("position", b) for b in levels[1:]})
    ranges = [f"range{b}" for b in levels]
    # nulls are skipped by the hash, so their places go in as a mask
    parts = [F.col(f"digest.f{i}") for i in range(len(fields))]
    mask = F.concat(F.lit("m"), *[F.when(p.isNull(), "1").otherwise("0") for p in parts])
    state = placed.groupBy(*ranges, "side", *names).agg(F.max("digest").alias("digest")).withColumn("checksum", F.xxhash64(*names, mask, *parts))
    of = lambda side: F.when(F.col("side") == side, F.col("checksum"))
    for depth in range(len(levels)):
        w = Window.partitionBy(*ranges[: depth + 1])
        same = F.bit_xor(of("l")).over(w).eqNullSafe(F.bit_xor(of("r")).over(w)) & (F.count(of("l")).over(w) == F.count(of("r")).over(w))
        state = state.withColumn("same", same).filter(~F.col("same"))
    digest = lambda side: F.max(F.when(F.col("side") == side, F.col("digest"))).alias(side)
    return state.groupBy(*ranges, *names).agg(digest("l"), digest("r")).select(*names, "l", "r")


def compare_copies(left: DataFrame, right: DataFrame, keys: Sequence[str], fields: Sequence[str], version: str | None = None, labels: tuple[str, str] = ("only_left", "only_right"), per_range: int = 4096, leaf_keys: int = 4) -> DataFrame:
    """One row (keys.., diff) for each key that one side lacks and each field whose values differ.

    Cases: null values are equal only to null; rows with a null key form one element of their own; repeated rows and older
    versions change nothing; an empty side makes all keys of the other one missing; extra columns on either side, whatever
    their names, are never read. Long values are compared by 64-bit hash, in the leaves only.
    """
    leaves = mismatched_leaves(left, right, keys, fields, version, per_range, leaf_keys)
    per_field = [F.when(~F.col(f"l.f{i}").eqNullSafe(F.col(f"r.f{i}")), F.lit(f)) for i, f in enumerate(fields)]
    diffs = F.when(F.col("r").isNull(), F.array(F.lit(labels[0]))).when(F.col("l").isNull(), F.array(F.lit(labels[1]))).otherwise(F.array_compact(F.array(*per_field)))
    return leaves.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], F.explode(diffs).alias("diff"))


def difference_values(left: DataFrame, right: DataFrame, key: str, fields: Sequence[str], version: str, labels: tuple[str, str] = ("only_left", "only_right")) -> DataFrame:
    """`compare_copies` with the stored values as text: (key, diff, left_value, right_value), both null for missing keys.

    Only rows of differing keys are joined back, reduced to the newest before the shuffle.
    """
    found = compare_copies(left, right, [key], fields, version, labels)
    wide = found.filter(~F.col("diff").isin(*labels)).groupBy(key).agg(F.collect_set("diff").alias("diffs"))

    def side(df: DataFrame, name: str) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        digest = F.struct(F.col(f"`{version}`").alias("version"), *[field_hash(F.col(f"`{f}`"), types[f]).alias(f"f{i}") for i, f in enumerate(fields)])
        values = F.struct(*[F.col(f"`{f}`").cast("string").alias(f"v{i}") for i, f in enumerate(fields)])
        rows = df.select(F.col(f"`{key}`").alias("k__"), digest.alias("digest"), values.alias("value"))
        rows = rows.join(wide.select(F.col(key).alias("wanted__")), F.col("k__").eqNullSafe(F.col("wanted__")), "left_semi")
        return rows.groupBy("k__").agg(F.max(F.struct("digest", "value")).alias("m")).select("k__", F.col("m.value").alias(name))

    joined = wide.join(side(left, "lv"), F.col(key).eqNullSafe(F.col("k__"))).drop("k__").join(side(right, "rv"), F.col(key).eqNullSafe(F.col("k__"))).drop("k__")
    pick = lambda v: F.array(*[F.struct(F.lit(f).alias("diff"), F.col(f"lv.v{i}").alias("left_value"), F.col(f"rv.v{i}").alias("right_value")) for i, f in enumerate(fields)])
    values = joined.select(key, F.explode(F.filter(pick(0), lambda x: F.array_contains("diffs", x["diff"]))).alias("d")).select(key, "d.*")
    missing = found.filter(F.col("diff").isin(*labels)).select(key, "diff", F.lit(None).cast("string").alias("left_value"), F.lit(None).cast("string").alias("right_value"))
    return missing.unionByName(values)
