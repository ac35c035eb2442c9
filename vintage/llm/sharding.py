"""Sharding by histogram sort: exact byte counts below probe keys, refined until the splitters fit, then one exchange.

Documents are ordered by (hash of the text, id, place in the input), so equal texts stand together and
every position can be split at, even inside a group of copies. Shards are cut where the running bytes
reach equal shares; each shard is cut further into pieces of a bounded size, one task each.

Rows are staged with their keys first: a place in the input depends on how it is split for reading, and the
rows that are moved must have the keys that were counted. A round counts bytes and rows in equal sub-ranges of
the ranges that still hold a splitter, and reads the keys alone. The driver sees these counts only: at most
1,024 a splitter and round.

Defined results: a null text has size 1 and a null checksum stays null; a null id sorts first; repeated
rows are split by their place; an empty table gives an empty result. The input is read once and may be any
frame. A long text is moved as a whole, so a shard may be off by one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.staging import packed, stage

LAW = "bytes"
SHARDS = 8
PROBE_BITS = 10
TOLERANCE = 0.001
PIECE_BYTES = 64 << 20
#: Cuts are literals of the plan. Beyond this many pieces they grow instead, and tasks sort with spills.
MAX_PIECES = 2048
KEYS = ("k0", "k1", "k2")
_LOW = -(1 << 63)


def keyed(df: DataFrame, carry: list[str]) -> DataFrame:
    """``row``, its size and the three parts of its sort key."""
    return df.select(
        packed(df, carry).alias("row"),
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.xxhash64("text").alias("k0"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW)).alias("k1"),
        F.monotonically_increasing_id().alias("k2"),
    )


@dataclass
class Splitter:
    """Searching the key with ``goal`` bytes below it: ``fixed`` leading parts, then the first bits of the next."""

    goal: float
    fixed: tuple[int, ...] = ()
    depth: int = 0
    prefix: int = 0
    below: int = 0
    cut: tuple[int, ...] | None = None

    @property
    def range(self) -> tuple[tuple[int, ...], int, int]:
        return self.fixed, self.depth, self.prefix


def _unsigned(name: str) -> Column:
    """A part of the key with its sign bit flipped, whose bits are in order."""
    return F.col(name).bitwiseXOR(F.lit(_LOW))


def _signed(value: int) -> int:
    return value - (1 << 63)


def _probe(table: DataFrame, ranges: list[tuple[tuple[int, ...], int, int]]) -> dict[int, list[tuple[int, int, int]]]:
    """Per range (of one depth) its sub-ranges with rows, in order: (sub-range, bytes, rows)."""
    fixed, depth, _ = ranges[0]
    key = _unsigned(KEYS[len(fixed)])
    found = None
    for i, (leading, _, prefix) in enumerate(ranges):
        inside = F.shiftrightunsigned(key, 64 - depth) == prefix if depth else F.lit(True)
        for name, value in zip(KEYS, leading, strict=False):
            inside = inside & (F.col(name) == _signed(value))
        found = F.when(inside, i) if found is None else found.when(inside, i)
    bits = min(PROBE_BITS, 64 - depth)
    sub = F.shiftrightunsigned(key, 64 - depth - bits).bitwiseAND(F.lit((1 << bits) - 1))
    sums = (
        table.withColumn("range", found)
        .filter("range IS NOT NULL")
        .groupBy("range", sub.cast("int").alias("sub"))
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    )
    result: dict[int, list[tuple[int, int, int]]] = {}
    for r in sorted(sums.collect(), key=lambda r: (r["range"], r["sub"])):
        result.setdefault(r["range"], []).append((r["sub"], r["size"], r["n"]))
    return result


def _advance(s: Splitter, counts: list[tuple[int, int, int]], slack: float) -> None:
    """Narrows a splitter by what was counted in its range, or cuts."""
    bits = min(PROBE_BITS, 64 - s.depth)
    width = 1 << (64 - s.depth - bits)
    for sub, size, n in counts:
        start = ((s.prefix << bits) + sub) * width
        over = s.below + size - s.goal
        if s.goal - s.below <= slack:
            s.cut = (*s.fixed, start)
        elif over >= 0 and (over <= slack or n == 1):
            s.cut = (*s.fixed, start if s.goal - s.below < over else start + width)
        elif over > 0 and width > 1:
            s.depth, s.prefix = s.depth + bits, (s.prefix << bits) + sub
        elif over > 0:  # one value holds several rows: go on with the next part of the key
            s.fixed, s.depth, s.prefix = (*s.fixed, start), 0, 0
        else:
            s.below += size
            continue
        return
    s.cut = (*s.fixed, 1 << 64)


def splitters(table: DataFrame, goals: list[float], slack: float) -> list[tuple[int, ...]]:
    """A key per goal: rows with smaller keys have the goal's bytes, up to ``slack`` or a row."""
    search = [Splitter(g) for g in goals]
    while opened := [s for s in search if s.cut is None]:
        at = min((len(s.fixed), s.depth) for s in opened)
        now = [s for s in opened if (len(s.fixed), s.depth) == at]
        ranges = sorted({s.range for s in now})
        counts = _probe(table, ranges)
        for s, of in [(s, ranges.index(s.range)) for s in now]:
            _advance(s, counts.get(of, []), slack)
    return sorted(s.cut for s in search)


def _not_below(cut: tuple[int, ...]) -> Column:
    """Whether a row's key is at or above ``cut`` (the leading parts of a key)."""
    result = F.lit(True)
    for name, value in reversed(list(zip(KEYS, cut, strict=False))):
        if value >> 64:
            result = F.lit(False)
        else:
            result = (F.col(name) > _signed(value)) | ((F.col(name) == _signed(value)) & result)
    return result


def shard(df: DataFrame, carry: list[str], shards: int = SHARDS, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``row``, ``size``, ``shard`` and ``slot`` (from 0 in each shard) for every row of ``df``."""
    rows = stage(keyed(df, carry))
    keys = rows.select("size", *KEYS)
    total = keys.agg(F.sum("size")).first()[0] or 0
    per_shard = max(1, min(-(-total // (shards * piece_bytes)), MAX_PIECES // shards))
    n = shards * per_shard
    goals = [total * k / n for k in range(1, n)]
    cuts = splitters(keys, goals, TOLERANCE * total / n) if total else []
    return exchange(rows, keys, cuts, per_shard)


def _placed(df: DataFrame, cuts: list[tuple[int, ...]]) -> DataFrame:
    """Adds ``piece``: the number of cuts at or below the key, by bisection over literals."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(_not_below(cuts[mid]), search(mid + 1, high)).otherwise(search(low, mid))

    return df.withColumn("piece", search(0, len(cuts)))


def exchange(rows: DataFrame, keys: DataFrame, cuts: list[tuple[int, ...]], per_shard: int) -> DataFrame:
    """Moves every row to the task of its piece, once, and numbers it there."""
    counts = {r["piece"]: r["n"] for r in _placed(keys, cuts).groupBy("piece").agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces = len(cuts) + 1
    before, start = [], 0
    for p in range(pieces):
        start = 0 if p % per_shard == 0 else start
        before.append(start)
        start += counts.get(p, 0)
    moved = _placed(rows, cuts).repartitionById(pieces, F.col("piece"))
    order = Window.partitionBy("piece").orderBy(*KEYS)
    first = F.element_at(F.array(*(F.lit(b).cast("long") for b in before)), F.col("piece") + 1)
    return moved.select(
        "row",
        "size",
        F.floor(F.col("piece") / per_shard).cast("int").alias("shard"),
        (first + F.row_number().over(order) - 1).alias("slot"),
    )
