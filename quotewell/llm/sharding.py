"""Shards of indivisible groups of documents by best-fit-decreasing bin packing.

Groups are the sets of documents with equal texts.  Spark adds up each group's
size and counts groups by size class; the packing itself runs over classes, not
groups: from the largest class down, as many of its groups as fit go to the bin
with the tightest remaining capacity that holds one.  Size classes keep twelve
significant bits, rounded up, so there are at most a few ten thousand whatever
the data, and the driver never sees a group.  Spark then ranks the groups of a
class and deals them out by the class's quotas.

Ranks and slots are gapless numbers found without sorting everything in one
task: rows are spread over blocks by a hash, counted per block, and numbered in
their block from where the blocks before it end.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotewell.llm.common import stored

#: Rows per block when numbering rows; blocks grow in number, not in size.
BLOCK_ROWS = 20_000
BITS = 12


class CapacityTree:
    """Bins by remaining capacity in a two-level balanced tree: sorted leaves under a sorted list of their first keys."""

    def __init__(self, leaf: int = 256) -> None:
        self.leaf, self.leaves, self.firsts = leaf, [], []

    def add(self, remaining: int, bin_number: int) -> None:
        key = (remaining, bin_number)
        if not self.leaves:
            self.leaves, self.firsts = [[key]], [key]
            return
        at = max(0, bisect_left(self.firsts, key) - 1)
        insort(self.leaves[at], key)
        self.firsts[at] = self.leaves[at][0]
        if len(self.leaves[at]) > 2 * self.leaf:
            right = self.leaves[at][self.leaf :]
            del self.leaves[at][self.leaf :]
            self.leaves.insert(at + 1, right)
            self.firsts.insert(at + 1, right[0])

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns (remaining, bin) with the least remaining capacity of at least ``size``."""
        key = (size, -1)
        at = max(0, bisect_left(self.firsts, key) - 1)
        while at < len(self.leaves):
            i = bisect_left(self.leaves[at], key)
            if i < len(self.leaves[at]):
                found = self.leaves[at].pop(i)
                if self.leaves[at]:
                    self.firsts[at] = self.leaves[at][0]
                else:
                    del self.leaves[at], self.firsts[at]
                return found
            at += 1
        return None


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int]]:
    """(size, bin, count) for ``classes`` of (size, number of groups); a size over the capacity gets bins of its own."""
    tree, bins, quotas = CapacityTree(), 0, []
    for size, count in sorted(classes, reverse=True):
        while count:
            found = tree.take_tightest(size)
            if found is None:
                found, bins = (max(capacity, size), bins), bins + 1
            remaining, number = found
            placed = min(count, remaining // size)
            quotas.append((size, number, placed))
            count -= placed
            tree.add(remaining - placed * size, number)
    return quotas


def fewest_capacity(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Quotas of the smallest capacity, found by bisection, at which best fit decreasing needs at most ``shards`` bins."""
    total = sum(size * count for size, count in classes)
    low = max([-(-total // shards), *(size for size, _ in classes)], default=1)
    best = best_fit_decreasing(classes, low)
    if not classes or max(b for _, b, _ in best) < shards:
        return best
    high = low
    while max(b for _, b, _ in best) >= shards:
        low, high = high + 1, high + max(1, high // 64)
        best = best_fit_decreasing(classes, high)
    while low < high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(classes, middle)
        if max(b for _, b, _ in tried) < shards:
            best, high = tried, middle
        else:
            low = middle + 1
    return best


def levelled(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Quotas that always give the largest remaining group to the least loaded shard, a class of equal groups at a time."""
    loads, quotas = [0] * shards, []
    for size, count in sorted(classes, reverse=True):
        room = lambda level: [max(0, (level - load) // size + 1) for load in loads]  # noqa: B023, E731  groups put in while at most at ``level``
        low, high = -1, max(loads) + size * (count // shards + 1)
        while low < high:  # the highest level at which there is not room for more than ``count``
            middle = (low + high + 1) // 2
            low, high = (middle, high) if sum(room(middle)) <= count else (low, middle - 1)
        placed = room(low)
        rest = count - sum(placed)
        for number in sorted(range(shards), key=lambda b: (loads[b] + placed[b] * size, b))[:rest]:
            placed[number] += 1
        for number, n in enumerate(placed):
            if n:
                loads[number] += n * size
                quotas.append((size, number, n))
    return quotas


def spread(quotas: list[tuple[int, int, int]], shards: int) -> tuple[int, int]:
    """(largest load, minus the smallest load): less is nearer to equal."""
    loads = [0] * shards
    for size, number, count in quotas:
        loads[number] += size * count
    return max(loads), -min(loads)


def nearest_equal(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Best fit decreasing at the smallest capacity, unless its last shards stay emptier than they need to.

    That happens where a group larger than a share, or few groups, force the
    capacity up: best fit then fills some shards to it and leaves others empty.
    """
    return min(fewest_capacity(classes, shards), levelled(classes, shards), key=lambda quotas: spread(quotas, shards))


def size_class(size: Column) -> Column:
    """``size`` rounded up to ``BITS`` significant bits."""
    unit = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.floor(F.log2(size)) - (BITS - 1))).cast("long")
    return (F.ceil(size / unit) * unit).cast("long")


def numbered_within(rows: DataFrame, keys: list[str], name: str, order: list[str], blocks: int) -> DataFrame:
    """``rows`` with a gapless number ``name`` from 0 within ``keys``, whatever share of them one key has.

    ``order`` must tell rows apart; its hash picks the block.
    """
    spread = rows.withColumn("block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    ahead = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        spread.groupBy(*keys, "block")
        .agg(F.count("*").alias("in_block"))
        .select(*keys, "block", F.coalesce(F.sum("in_block").over(ahead), F.lit(0)).alias("before"))
    )
    local = Window.partitionBy(*keys, "block").orderBy(*order)
    return (
        spread.withColumn("local", F.row_number().over(local) - 1)
        .join(starts, [*keys, "block"])
        .withColumn(name, (F.col("before") + F.col("local")).cast("long"))
        .drop("block", "local", "before")
    )


def shard(docs: DataFrame, shards: int = 24) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for each row of ``docs``, with equal texts in one shard.

    The size is the text's UTF-8 bytes plus 8; a null text has no bytes, and all
    null texts are one group, apart from the empty ones.  The largest shard is as
    small as best fit decreasing gets it, or as giving each group to the least
    loaded shard does, whichever is nearer to equal; a group larger than a
    share fills a shard alone and the others share the rest.  Slots are gapless from 0 in each shard.  Repeated rows and
    ids are placed as often as they occur.  An empty table gives no rows.
    """
    rows = stored(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
            F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("text_hash"),
        ),
        "shard-rows",
    )
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    groups = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes")).select("text_hash", size_class(F.col("bytes")).alias("size_class"))
    groups = stored(groups, "shard-groups")
    counts = groups.groupBy("size_class").agg(F.count("*").alias("n")).collect()  # bounded by the number of classes
    quotas = nearest_equal([(r["size_class"], r["n"]) for r in counts], shards)
    spans, first = [], {}
    for size, number, count in quotas:
        begin = first.get(size, 0)
        first[size] = begin + count
        spans.append((size, number, begin, begin + count))
    table = docs.sparkSession.createDataFrame(spans, "size_class long, shard int, begin long, finish long")
    ranked = numbered_within(groups, ["size_class"], "rank", ["text_hash"], blocks)
    placed = ranked.join(
        table, (ranked["size_class"] == table["size_class"]) & (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("finish"))
    ).select("text_hash", "shard")
    return numbered_within(rows.join(placed, "text_hash"), ["shard"], "slot", ["uid"], blocks).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def shard_digest(sharded: DataFrame) -> DataFrame:
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
