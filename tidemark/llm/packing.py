"""Filling fixed-capacity containers: dominance reduction on the histogram of sizes, best fit for the rest."""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import Scratch

#: Letters and digits as Python's \\w has them, without and with the underscore; white space as its \\s.
_WORD, _SPACE = r"\p{L}\p{N}_", r"\s\x1c-\x1f\x85\p{Z}"
TOKENS = rf"[{_WORD}]+|[^{_WORD}{_SPACE}]+"


def token_count(text: Column) -> Column:
    """Matches of \\w+|[^\\w\\s]+ (Unicode); null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKENS)), F.lit(0))


class _Sizes:
    """A multiset of sizes, one entry per distinct size, with the searches the reduction needs. ``gone`` is left out of
    a search without being taken."""

    def __init__(self, counts: dict[int, int]):
        self.count = {s: n for s, n in counts.items() if n > 0}
        self.order = sorted(self.count)

    def take(self, size: int, n: int) -> None:
        self.count[size] -= n
        if not self.count[size]:
            del self.count[size]
            self.order.pop(bisect.bisect_left(self.order, size))

    def left(self, size: int, gone: tuple[int, ...]) -> int:
        return self.count[size] - gone.count(size)

    def up_to(self, limit: int, gone: tuple[int, ...]) -> int | None:
        """The largest size that is at most ``limit``."""
        i = bisect.bisect_right(self.order, limit) - 1
        while i >= 0 and not self.left(self.order[i], gone):
            i -= 1
        return self.order[i] if i >= 0 else None

    def smallest(self, n: int, gone: tuple[int, ...]) -> list[int]:
        """The n smallest items (fewer if there are not that many)."""
        out: list[int] = []
        for s in self.order:
            out += [s] * min(n - len(out), self.left(s, gone))
            if len(out) == n:
                break
        return out

    def best_pair(self, limit: int, gone: tuple[int, ...], above: int = 0) -> tuple[int, int] | None:
        """Two items, both larger than ``above``, with the largest sum of at most ``limit``; the larger one first."""
        lo, hi, best, most = bisect.bisect_right(self.order, above), bisect.bisect_right(self.order, limit) - 1, None, 0
        while lo <= hi:
            small, large = self.order[lo], self.order[hi]
            if not self.left(large, gone):
                hi -= 1
            elif not self.left(small, gone):
                lo += 1
            elif small + large > limit or (lo == hi and self.left(small, gone) < 2):
                hi -= 1
            else:
                if small + large > most:
                    best, most = (large, small), small + large
                lo += 1
        return best


def dominating(sizes: _Sizes, w: int, capacity: int) -> tuple[int, ...] | None:
    """What goes beside an item of size w in a set that dominates every feasible set with w, or None.

    A set dominates another if the other's items can be parted into groups that each fit the place of one of its items:
    exchanging them then never costs a container. With f the largest item that fits the room beside w,
    {w} dominates if nothing fits; {w, f} if f fills the room, or no two items fit (any other set has one item, at most
    f), or no three fit and f is at least as large as the best pair. {w, f, b}, the best pair that has f, dominates if
    no three items fit and every feasible pair has an item of at most b, or fits into f's place as a whole: a pair with f
    and more than b does not fit, as the best pair is the largest; a pair with at most b has the other item at most f.
    """
    gone, room = (w,), capacity - w
    f = sizes.up_to(room, gone)
    if f is None:
        return ()
    if f == room:
        return (f,)
    few = sizes.smallest(3, gone)
    if len(few) < 2 or few[0] + few[1] > room:
        return (f,)
    if len(few) == 3 and sum(few) <= room:
        return None
    a, b = sizes.best_pair(room, gone)
    if f >= a + b:
        return (f,)
    if a != f:
        return None
    other = sizes.best_pair(room, (w, a), above=b)
    return (a, b) if other is None or sum(other) <= a else None


def reduce_histogram(sizes: _Sizes, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Martello-Toth reduction: every item, the largest first, is tried for a dominating set, which is fixed for good;
    sets of equal sizes are fixed at once, as removing items never makes a dominating set of those left cease to be one.
    Passes go on until one fixes nothing. ``sizes`` keeps the shrunk instance."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    moved = True
    while moved:
        moved = False
        for w in sizes.order[::-1]:
            while w in sizes.count:
                beside = dominating(sizes, w, capacity)
                if beside is None:
                    break
                pattern = (w, *beside)
                times = min(sizes.count[s] // pattern.count(s) for s in pattern)
                for s in set(pattern):
                    sizes.take(s, pattern.count(s) * times)
                fixed.append((pattern, times))
                moved = True
    return fixed


def best_fit(sizes: _Sizes, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit of the items, largest first: each goes where it leaves the least room. Containers filled alike are one
    entry with a count, so the work grows with the number of distinct sizes: an item's container stays the fullest one
    that fits until it is full for this size, so containers take as many of a size as they hold, one after the other."""
    rooms: dict[int, list[list]] = {}  # room -> [filling, number of containers]
    open_: list[int] = []

    def put(filling: tuple[int, ...], room: int, n: int) -> None:
        if n:
            if room not in rooms:
                bisect.insort(open_, room)
            rooms.setdefault(room, []).append([filling, n])

    for s in reversed(sizes.order):
        n = sizes.count[s]
        while n:
            i = bisect.bisect_left(open_, s)
            room = open_[i] if i < len(open_) else capacity
            each = room // s
            if i < len(open_):
                filling, have = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    open_.pop(i)
            else:
                filling, have = (), -(-n // each)
            full = min(have, n // each)
            put(filling + (s,) * each, room - s * each, full)
            n -= full * each
            have -= full
            if have and n:  # the last ones do not fill a whole container
                put(filling + (s,) * n, room - s * n, 1)
                n, have = 0, have - 1
            put(filling, room, have if filling else 0)
    return [(filling, n) for room in sorted(rooms) for filling, n in rooms[room]]


def pack_histogram(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], int]:
    """Fillings as (sizes, number of containers filled so), and how many containers the reduction fixed: the dominance
    reduction, then best fit for what is left. The work depends on the number of distinct sizes (at most
    ``capacity``), not of items."""
    sizes = _Sizes(counts)
    fixed = reduce_histogram(sizes, capacity)
    return fixed + best_fit(sizes, capacity), sum(n for _, n in fixed)


def fill_containers(
    items: DataFrame,
    capacity: int = 2048,
    id_col: str = "doc_id",
    size_col: str = "size",
    block_rows: int = 50_000,
) -> DataFrame:
    """The container of each item or piece: (id_col, piece, first, size, container_id).

    An item larger than the capacity is cut into full pieces, each a container of its own, and a last piece that is
    packed like the others; no other item is split. ``first`` is the piece's first position in the item, from 0.
    Items are counted by size in one aggregation; the histogram, at most ``capacity`` rows whatever the number of
    items, is packed on the driver (see ``pack_histogram``), globally and not per partition. Items are numbered
    within their size in blocks of about ``block_rows`` whose offsets come from the blocks' counts, so a size that
    a third of all items have is no hot task, and look their container up in the broadcast fillings.

    Defined cases: null and non-positive sizes take no room and go to container (hash of the id) modulo the number
    of containers; repeated ids are separate items; null ids are items too; an empty table gives no rows; other
    columns are ignored.
    """
    spark = items.sparkSession
    scratch = Scratch(spark)
    kind = items.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.col(f"`{size_col}`").cast("bigint"), F.lit(0))
    slim = scratch.keep(items.select(F.col(f"`{id_col}`").alias("id"), F.greatest(size, F.lit(0)).alias("n"), F.monotonically_increasing_id().alias("row")), "sizes")
    rest = F.col("n") % capacity
    counts = {r["s"]: r["c"] for r in slim.groupBy(rest.cast("int").alias("s")).agg(F.count("*").alias("c")).collect()}  # at most `capacity` rows
    totals = slim.agg(F.sum(F.floor(F.col("n") / capacity)).alias("full"), F.count("*").alias("rows")).first()
    full, rows = int(totals["full"] or 0), totals["rows"]
    counts.pop(0, None)
    patterns, _ = pack_histogram(counts, capacity)

    # Fillings as intervals of ranks: items of size s with rank in [lo, hi) go, `per` to a container, from `base` on.
    used, base, table = dict.fromkeys(counts, 0), 0, []
    for pattern, times in patterns:
        for s in set(pattern):
            per = pattern.count(s)
            table.append((s, used[s], base, per))
            used[s] += per * times
        base += times
    table.sort()
    fillings = spark.sparkContext.broadcast(
        (np.array([s * 2**44 + lo for s, lo, _, _ in table], np.int64), np.array([b for _, _, b, _ in table], np.int64), np.array([p for *_, p in table], np.int64), np.array([lo for _, lo, _, _ in table], np.int64))
    )
    n_containers = max(1, base + full)

    # Rank within a size: the offset of the block plus the row's number in it.
    blocks = max(1, min(-(-rows // block_rows), 100_000))  # beyond, blocks grow; the offsets stay one task's small work
    parts = slim.withColumns({"s": rest.cast("int"), "block": F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")})
    by_size = Window.partitionBy("s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.filter("s > 0").groupBy("s", "block").agg(F.count("*").alias("c")).select("s", "block", F.coalesce(F.sum("c").over(by_size), F.lit(0)).alias("offset"))
    numbered = parts.withColumn("in_block", F.row_number().over(Window.partitionBy("s", "block").orderBy("row")) - 1).join(offsets, ["s", "block"], "left")

    # Full pieces take the containers after the fillings, each item's in a row: their offsets work the same way.
    whole = F.floor(F.col("n") / capacity).cast("bigint")
    large = slim.filter(F.col("n") >= capacity).withColumns({"whole": whole, "block": F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")})
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # over one row per block
    starts = large.groupBy("block").agg(F.sum("whole").alias("c")).select("block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    in_block = Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = large.withColumn("at", F.coalesce(F.sum("whole").over(in_block), F.lit(0))).join(F.broadcast(starts), "block")
    pieces = placed.select("id", F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).alias("piece", "k"), (F.col("offset") + F.col("at") + base).alias("from"))
    full_rows = pieces.select("id", F.col("piece").cast("int").alias("piece"), (F.col("k") * capacity).alias("first"), F.lit(capacity).cast("bigint").alias("size"), (F.col("from") + F.col("k")).alias("container_id"))

    @F.pandas_udf("bigint")
    def container(s: pd.Series, rank: pd.Series) -> pd.Series:
        keys, bases, per, lows = fillings.value
        at = np.searchsorted(keys, s.to_numpy(np.int64) * 2**44 + rank.to_numpy(np.int64), side="right") - 1
        return pd.Series(bases[at] + (rank.to_numpy(np.int64) - lows[at]) // per[at]) if len(s) else pd.Series([], dtype="int64")

    some = numbered.filter("s > 0").withColumn("container_id", container("s", F.col("offset") + F.col("in_block")))
    none = parts.filter("n = 0").withColumn("container_id", F.pmod(F.xxhash64("id"), F.lit(n_containers)))
    small = lambda df: df.select("id", whole.cast("int").alias("piece"), (whole * capacity).alias("first"), F.col("s").cast("bigint").alias("size"), "container_id")
    out = small(some).unionByName(full_rows).unionByName(small(none))
    return out.withColumnRenamed("id", id_col)
