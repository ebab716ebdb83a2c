"""Filling sequences of fixed capacity with documents.

Only sizes matter to a packing, and there are at most `capacity` of them, so the whole instance is a histogram. It is solved
on the driver whatever the number of documents: sets of up to three documents that dominate every alternative are fixed
(reduction by Martello and Toth), as often as the counts allow, and best-fit decreasing places the rest. The solution is a
list of patterns with multiplicities; each document finds its sequence from its rank among documents of its size.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvarto.session import checkpointed


class _Sizes:
    """A multiset of sizes, kept sorted."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: c for s, c in counts.items() if c > 0}
        self.sorted = sorted(self.n)

    def take(self, size: int, count: int) -> None:
        self.n[size] -= count
        if not self.n[size]:
            del self.n[size]
            self.sorted.pop(bisect_left(self.sorted, size))

    def put(self, size: int, count: int) -> None:
        if count and size not in self.n:
            insort(self.sorted, size)
        if count:
            self.n[size] = self.n.get(size, 0) + count

    def largest(self, limit: int) -> int | None:
        i = bisect_right(self.sorted, limit)
        return self.sorted[i - 1] if i else None

    def smallest(self, k: int) -> int | None:
        """The sum of the k smallest items, None if there are fewer."""
        total = 0
        for s in self.sorted:
            m = min(k, self.n[s])
            total += m * s
            k -= m
            if not k:
                return total
        return None

    def pairs(self, limit: int) -> tuple[int, int]:
        """(largest sum of two items within the limit, largest smaller item of such a pair); zeros if none fits."""
        best = second = 0
        i, j = 0, bisect_right(self.sorted, limit) - 1
        while i <= j:
            low, high = self.sorted[i], self.sorted[j]
            if low + high > limit:
                j -= 1
                continue
            if i < j or self.n[low] > 1:
                best = max(best, low + high)
                second = max(second, low)
            i += 1
        return best, second


def _dominating(sizes: _Sizes, j: int, capacity: int) -> tuple[int, ...] | None:
    """A set with j (already taken out of sizes) of at most three items that dominates all sets with j, if one can be proved to."""
    room = capacity - j
    smallest = sizes.smallest(1)
    if smallest is None or smallest > room:
        return (j,)
    k = sizes.largest(room)
    if k == room:
        return j, k
    two = sizes.smallest(2)
    if two is None or two > room:
        return j, k
    three = sizes.smallest(3)
    if three is not None and three <= room:
        return None
    # at most two more items fit
    most, second = sizes.pairs(room)
    if k >= most:
        return j, k
    sizes.take(k, 1)
    b = sizes.largest(room - k)
    sizes.put(k, 1)
    if b is not None and second <= b:
        return j, k, b
    return None


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(sizes of one sequence, number of such sequences) that hold all items. Sizes must lie in 1..capacity."""
    sizes, patterns = _Sizes(counts), []
    changed = True
    while changed:
        changed = False
        j = sizes.sorted[-1] if sizes.sorted else None
        while j is not None:
            sizes.take(j, 1)
            found = _dominating(sizes, j, capacity)
            sizes.put(j, 1)
            if found:
                times = min(sizes.n[s] // found.count(s) for s in set(found))
                # taking items away only removes alternatives, so what dominates once dominates as long as its sizes last
                for s in found:
                    sizes.take(s, times)
                patterns.append((found, times))
                changed = True
                if j in sizes.n:
                    continue
            j = sizes.largest(j - 1)
    return patterns + _best_fit(sizes, capacity)


def _best_fit(sizes: _Sizes, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over a histogram: equal sequences are handled together."""
    groups: dict[int, list[list]] = defaultdict(list)  # room left -> [pattern, count]
    rooms: list[int] = []
    full: list[tuple[tuple[int, ...], int]] = []

    def add(room: int, pattern: tuple[int, ...], count: int) -> None:
        if room == 0:
            full.append((pattern, count))
            return
        if room not in groups:
            insort(rooms, room)
        groups[room].append([pattern, count])

    for size in reversed(sizes.sorted):
        left = sizes.n[size]
        while left:
            i = bisect_left(rooms, size)
            if i < len(rooms):
                room = rooms[i]
                group = groups[room][-1]
                each = room // size  # the fullest sequence that fits stays the fullest until it is full
                whole = min(group[1], left // each)
                pattern = group[0]
                take, used = (each, whole) if whole else (left, 1)
                group[1] -= used
                if not group[1]:
                    groups[room].pop()
                    if not groups[room]:
                        del groups[room]
                        rooms.pop(i)
                add(room - take * size, pattern + (size,) * take, used)
                left -= take * used
            else:
                each = capacity // size
                whole, rest = divmod(left, each)
                if whole:
                    add(capacity - each * size, (size,) * each, whole)
                if rest:
                    add(capacity - rest * size, (size,) * rest, 1)
                left = 0
    return full + [(p, n) for room in rooms for p, n in groups[room] if n]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, last rank, first sequence, offset in the sequence) of each run of items that lie alike in consecutive sequences."""
    next_rank: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            rank = next_rank[size]
            out.append((size, rank, rank + count - 1, sequence, offset))
            next_rank[size] = rank + count
            offset += size
        sequence += count
    return out


def ranked(df: DataFrame, group: str, order: list[Column], bucket_rows: int = 200_000) -> DataFrame:
    """Adds `rank`, 0.. within each group, in the order of a hash; a large group is ranked in hash buckets, never in one task.

    The bucket's start comes from the bucket counts, so no window spans more than a bucket.
    """
    buckets = max(1, -(-df.count() // bucket_rows))
    hashed = df.withColumn("hash__", F.xxhash64(*order)).withColumn("bucket__", F.pmod("hash__", F.lit(buckets)))
    starts = hashed.groupBy(group, "bucket__").agg(F.count("*").alias("n__"))
    before = Window.partitionBy(group).orderBy("bucket__").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("start__", F.coalesce(F.sum("n__").over(before), F.lit(0))).drop("n__")
    inside = Window.partitionBy(group, "bucket__").orderBy("hash__", *order)
    return hashed.withColumn("at__", F.row_number().over(inside) - 1).join(starts, [group, "bucket__"]).withColumn("rank", F.col("start__") + F.col("at__")).drop("hash__", "bucket__", "start__", "at__")


def pieces_of(sized: DataFrame, capacity: int) -> DataFrame:
    """(id, piece, size): a document itself, or, if larger than the capacity, full pieces and the rest."""
    full = F.floor(F.col("tokens") / capacity).cast("int")
    last = F.col("tokens") % capacity
    count = F.when(F.col("tokens") <= capacity, 1).otherwise(full + (last > 0).cast("int"))
    cut = sized.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    size = F.when(F.col("tokens") <= capacity, F.col("tokens")).when(F.col("piece") < full, F.lit(capacity)).otherwise(last)
    return cut.select("id", "piece", size.cast("int").alias("size"))


def pack(sized: DataFrame, capacity: int) -> DataFrame:
    """(id, piece, size, sequence, place) of every document, or piece of one too large, from (id, tokens).

    Cases: documents without tokens need no room and get no sequence (null); null sizes count as 0; repeated ids are items of
    their own; an empty table gives an empty packing. Only documents above the capacity are split.
    """
    if capacity < 1:
        raise ValueError("a sequence must hold at least one token")
    spark = sized.sparkSession
    items = pieces_of(sized.select("id", F.coalesce("tokens", F.lit(0)).alias("tokens")), capacity)
    counts = {r["size"]: r["n"] for r in items.filter("size > 0").groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    runs = slots(pack_histogram(counts, capacity))
    table = spark.createDataFrame(runs or [(0, 0, -1, 0, 0)], "size int, first long, last long, sequence0 long, place long")
    placed = ranked(items.filter("size > 0"), "size", [F.col("id"), F.col("piece")])
    # many runs of a size are told apart by rank: cut runs and ranks into blocks so that the join stays an equality
    block = 65_536
    table = table.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), F.greatest(F.floor(F.col("first") / block), F.floor(F.col("last") / block)))))
    placed = placed.withColumn("block", F.floor(F.col("rank") / block))
    joined = placed.join(table, (placed["size"] == table["size"]) & (placed["block"] == table["block"]) & placed["rank"].between(table["first"], table["last"]))
    out = joined.select("id", "piece", placed["size"], (F.col("sequence0") + F.col("rank") - F.col("first")).alias("sequence"), "place")
    none = items.filter("size = 0").select("id", "piece", "size", F.lit(None).cast("long").alias("sequence"), F.lit(None).cast("long").alias("place"))
    return out.unionByName(none)


def filling(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: sequences, tokens held, tokens of room left unused, and the share filled."""
    agg = packed.agg(F.coalesce(F.max("sequence") + 1, F.lit(0)).alias("sequences"), F.coalesce(F.sum("size"), F.lit(0)).alias("tokens"))
    return agg.withColumn("unused", F.col("sequences") * capacity - F.col("tokens")).withColumn("filled", F.when(F.col("sequences") > 0, F.col("tokens") / (F.col("sequences") * capacity)))


def sized_once(df: DataFrame) -> DataFrame:
    """Counting tokens is the costly step; its result, a few bytes a document, is written once and read for every capacity."""
    return checkpointed(df)
