"""Trie of conversation prefixes: which beginnings conversations share, and what sharing them saves.

A conversation is the path of its turns' digests (of role and text), and a node is a prefix of such paths.
Conversations are dealt into shards in the order of their paths, equal paths by conv_id, so each subtree lies
in neighbouring shards and a group of copies spreads over as many as it needs. A shard

1. enumerates its distinct prefix digests;
2. gives each a slot by a minimal perfect hash and checks every look-up against the digest in the slot;
3. scatters counts, smallest members and parents into flat NumPy arrays by slot;
4. adds leaves and savings into parent slots, depth by depth from the deepest.

Only nodes on the path of the first or the last conversation of a shard can lie in several. Their partial sums
meet in the crown, which is a node table of its own (at most two paths a shard) and is filled the same way.

Defined results: turns are ordered by turn, null first, equal ones by digest; a null role or text is the empty
one; equal rows are turns of their own; rows without conv_id take no part. Other columns are not read, so names
cannot clash. No conversations give no nodes, not even a root. Turns travel as digests and lengths, so long
texts do not matter. The turns of one conversation (24 bytes each) must fit in a task, as its path is a value;
ends_sha256 of a node is one sequence over its members' ids, hashed as a stream by one task for each node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.staging import stage

#: Turns of a shard.
SHARD_TURNS = 400_000
#: Ids of a piece of a list that several shards hold.
PIECE_IDS = 4096
#: A crown of so many nodes (40 bytes each) is broadcast, a larger one joined.
BROADCAST_NODES = 100_000
#: Conversations whose number differs in the last two digits begin alike.
FAMILY, SHARED = 100, 6
_ROOT = bytes(16)
_NODE = "digest binary, parent binary, depth long, chars long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


# --- rebuilt conversations ---


def _numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, said, chars): the turns of each conversation from 1, as digests and lengths."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    said = F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, 16)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", said.alias("said"), F.length(text).cast("long").alias("chars")
    )
    in_order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "said")
    return turns.select("conv_id", F.row_number().over(in_order).alias("place"), "said", "chars")


def _head_of(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, said, chars): each conversation as the head of its family's first one and its own rest."""
    numbered = stage(_numbered(conversations))
    conv = F.col("conv_id")
    own = numbered.where(F.col("place") > _head_of(conv))
    convs = numbered.where(F.col("place") == 1).select("conv_id")
    first = numbered.where((conv % FAMILY == 0) & (F.col("place") < SHARED)).withColumnRenamed("conv_id", "first")
    wanted = convs.select("conv_id", (conv - conv % FAMILY).alias("first"), _head_of(conv).alias("head"))
    heads = wanted.join(first, "first").where(F.col("place") <= F.col("head")).select(*numbered.columns)
    nothing = convs.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("binary").alias("said"), F.lit(None).cast("long").alias("chars"))
    turns = own.unionByName(heads).unionByName(nothing).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "said", "chars"))).alias("turns")
    )
    turns = turns.withColumn("turns", F.filter("turns", lambda t: t["place"] > 0))
    return turns.select("conv_id", F.col("turns.said").alias("said"), F.col("turns.chars").alias("chars"))


# --- the node table ---


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1B54A32D192ED03 % 2**64))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class NodeTable:
    """Slots 0 to n - 1 for n distinct digests (rows of two 64-bit words).

    Level by level, digests that are alone at their hashed position keep it and the others go on to the next
    level. A slot is the number of kept positions before it. Looking up a digest that has no slot raises.
    """

    def __init__(self, keys: np.ndarray):
        self._levels, left, first = [], keys, 0
        while len(left):
            if len(self._levels) == 200:
                raise ValueError("equal digests cannot have slots of their own")
            size = 2 * len(left)
            at = (_mixed(left, len(self._levels)) % np.uint64(size)).astype(np.int64)
            kept = np.bincount(at, minlength=size) == 1
            self._levels.append((size, kept, first + np.cumsum(kept) - 1))
            first += int(kept.sum())
            left = left[~kept[at]]
        self.keys = np.zeros_like(keys)
        self.keys[self._slots(keys)] = keys

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        slot, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for seed, (size, kept, rank) in enumerate(self._levels):
            at = (_mixed(keys[open_], seed) % np.uint64(size)).astype(np.int64)
            slot[open_[kept[at]]] = rank[at[kept[at]]]
            open_ = open_[~kept[at]]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slots(keys)
        if (slot < 0).any() or (self.keys[slot] != keys).any():
            raise KeyError("a digest is not in the table")
        return slot


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


def _digests(words: np.ndarray) -> pa.Array:
    return pa.array([w.tobytes() for w in np.ascontiguousarray(words)], pa.binary())


def add_upwards(depth: np.ndarray, parent: np.ndarray, passes: np.ndarray, *sums: np.ndarray) -> None:
    """Add each slot's sums to its parent slot, the deepest first; only slots that ``passes`` marks do."""
    order = np.argsort(depth, kind="stable")
    ends = np.searchsorted(depth[order], np.arange(depth.max() + 2))
    for d in range(int(depth.max()), 0, -1):
        level = order[ends[d] : ends[d + 1]]
        level = level[passes[level]]
        for s in sums:
            np.add.at(s, parent[level], s[level])


def _sha(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


_SHARD = _NODE + ", crossing boolean, parent_conv_id long, ends_sha256 string, piece_no long, piece string"


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the conversations of one shard, and pieces of the id lists of those that cross its borders."""
    digests, chars, convs, starts = [], [], [], [0]
    path, said_before, new = [_ROOT], [], []
    for batch in batches:
        for conv, said, lengths in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "said", "chars"))):
            same = 0
            while same < min(len(said), len(said_before)) and said[same] == said_before[same]:
                same += 1
            del path[same + 1 :]
            for s in said[same:]:
                path.append(hashlib.blake2b(path[-1] + s, digest_size=16).digest())
            # Conversations come in the order of their paths: a prefix is new if the one before has no such beginning.
            new += [not convs] + [i >= same for i in range(len(said))]
            digests += path
            chars += [0, *lengths]
            convs.append(conv)
            starts.append(len(digests))
            said_before = said
    if not convs:
        return
    starts, convs, new = np.array(starts), np.array(convs, np.int64), np.flatnonzero(new)
    per_conv = np.diff(starts)
    row_depth = np.arange(len(digests)) - np.repeat(starts[:-1], per_conv)
    keys = _words(digests)
    table = NodeTable(keys[new])
    slot, n = table.slots(keys), len(new)
    depth, length, parent = np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, -1, np.int64)
    at = slot[new]
    depth[at], length[at] = row_depth[new], np.array(chars, np.int64)[new]
    below = new[row_depth[new] > 0]
    parent[slot[below]] = slot[below - 1]
    n_convs, least = np.bincount(slot, minlength=n), np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, np.repeat(convs, per_conv))
    crossing = np.zeros(n, bool)
    crossing[slot[: starts[1]]] = crossing[slot[starts[-2] :]] = True
    whole = ~crossing
    children = np.bincount(parent[whole], minlength=n)
    leaves = np.where(whole & (children == 0), 1, 0)
    saved = np.where(whole, (n_convs - 1) * length, 0)
    add_upwards(depth, parent, whole, leaves, saved)

    last = slot[starts[1:] - 1]
    runs = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
    ends: list = [None if c else hashlib.sha256().hexdigest() for c in crossing]
    pieces: list[tuple] = []
    number = TaskContext.get().partitionId() << 32
    for a, b in zip(runs, [*runs[1:], len(convs)]):
        if whole[last[a]]:
            ends[last[a]] = _sha(convs[a:b])
            continue
        for i in range(a, b, PIECE_IDS):
            pieces.append((table.keys[last[a]], number + i, ",".join(map(str, convs[i : min(b, i + PIECE_IDS)].tolist()))))
    up = np.maximum(parent, 0)
    nodes = {
        "digest": _digests(table.keys),
        "parent": _digests(table.keys[up]),
        "depth": depth,
        "chars": length,
        "conv_id": least,
        "n_convs": n_convs,
        "n_children": children,
        "n_leaves": leaves,
        "saved_tokens": saved,
        "crossing": crossing,
        "parent_conv_id": pa.array(least[up], mask=(parent < 0) | crossing[up]),
        "ends_sha256": pa.array(ends, pa.string()),
        "piece_no": pa.nulls(n, pa.int64()),
        "piece": pa.nulls(n, pa.string()),
    }
    nodes = pa.RecordBatch.from_pydict({k: pa.array(v) if isinstance(v, np.ndarray) else v for k, v in nodes.items()})
    yield nodes
    if pieces:
        listed = {f.name: pa.nulls(len(pieces), f.type) for f in nodes.schema}
        listed["digest"] = _digests(np.array([k for k, _, _ in pieces]))
        listed["piece_no"] = pa.array([i for _, i, _ in pieces], pa.int64())
        listed["piece"] = pa.array([p for _, _, p in pieces], pa.string())
        yield pa.RecordBatch.from_pydict(listed)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, ends_sha256) from pieces in order, as a stream."""
    digest, state = None, None
    row = lambda: pa.RecordBatch.from_pydict({"digest": pa.array([digest], pa.binary()), "ends_sha256": [state.hexdigest()]})
    for batch in batches:
        for d, piece in zip(batch.column("digest"), batch.column("piece")):
            if d.as_py() != digest:
                if state:
                    yield row()
                digest, state = d.as_py(), hashlib.sha256(piece.as_py().encode())
            else:
                state.update(b"," + piece.as_py().encode())
    if state:
        yield row()


def _crown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that cross shards, finished: what they add to each other, and their parents' smallest members."""
    batches = list(batches)
    if not sum(b.num_rows for b in batches):
        return
    table = pa.Table.from_batches(batches)
    column = lambda c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False)
    keys = _words(table.column("digest").to_pylist())
    slots = NodeTable(keys)
    place = slots.slots(keys)
    by_slot = np.argsort(place)
    depth, chars, conv, n_convs, children, leaves, saved = (
        column(c)[by_slot].copy() for c in ("depth", "chars", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    )
    below = depth > 0
    parent = np.full(len(depth), -1, np.int64)
    parent[below] = slots.slots(_words(table.column("parent").take(pa.array(by_slot[below])).to_pylist()))
    children += np.bincount(parent[below], minlength=len(depth))
    leaves += children == 0
    saved += (n_convs - 1) * chars
    add_upwards(depth, parent, np.ones(len(depth), bool), leaves, saved)
    yield pa.RecordBatch.from_pydict({
        "digest": _digests(slots.keys), "depth": depth, "conv_id": conv,
        "parent_conv_id": pa.array(conv[np.maximum(parent, 0)], mask=~below),
        "n_convs": n_convs, "n_children": children, "n_leaves": leaves, "saved_tokens": saved,
    })


def nodes(paths: DataFrame) -> DataFrame:
    """One row for each distinct prefix of ``paths`` (conv_id, said, chars), in no order."""
    paths = stage(paths)
    n_turns = paths.agg(F.coalesce(F.sum(F.size("said") + 1), F.lit(0))).first()[0]
    parts = max(paths.sparkSession.sparkContext.defaultParallelism, n_turns // SHARD_TURNS)
    dealt = paths.repartitionByRange(parts, "said", "conv_id").sortWithinPartitions("said", "conv_id")
    found = stage(dealt.mapInArrow(_shard, _SHARD))
    part = found.where(F.col("piece").isNull())
    met = part.where("crossing").groupBy("digest").agg(
        *(F.first(c).alias(c) for c in ("parent", "depth", "chars")),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    shape = "digest binary, depth long, " + ", ".join(f"{c} long" for c in columns if c != "depth")
    pieces = found.where(F.col("piece").isNotNull()).select("digest", "piece_no", "piece")
    hashed = pieces.repartition("digest").sortWithinPartitions("digest", "piece_no").mapInArrow(_hashed, "digest binary, ends_sha256 string")
    crown = met.coalesce(1).mapInArrow(_crown, shape).join(hashed, "digest", "left")
    crown = stage(crown.fillna(hashlib.sha256().hexdigest(), "ends_sha256").select("digest", *columns, "ends_sha256"))

    inner = part.where(~F.col("crossing"))
    known = inner.where(F.col("parent_conv_id").isNotNull())
    above = crown.select(F.col("digest").alias("parent"), F.col("conv_id").alias("above"))
    above = F.broadcast(above) if crown.count() <= BROADCAST_NODES else above
    hung = inner.where(F.col("parent_conv_id").isNull()).join(above, "parent").withColumn("parent_conv_id", F.col("above"))
    wanted = [*columns, "ends_sha256"]
    return known.select(*wanted).unionByName(hung.select(*wanted)).unionByName(crown.select(*wanted))


def shared_prefixes(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie over all rebuilt conversations."""
    return nodes(rebuilt(conversations))
