"""Byte-level BPE encoding and decoding on length-bucketed padded matrices.

A text is split by a pattern into pieces, which are encoded apart. Pieces not seen before by a worker
are put into matrices by length, a row each. In every round each row merges its leftmost pair of
lowest rank, found in a hash table of pairs, and rows without a pair left are taken out. Encoded
pieces are kept in a bounded cache, as most pieces of a text have occurred before.

Pieces too long for a matrix, whose rounds would grow with the square of the length, are merged by a
heap in the same order, with the same result.

Defined results: a null text is the empty text, which has no ids; every row keeps its row, also repeated
ones; an empty table gives an empty result; columns outside ``carry`` are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.llm.staging import packed

NONE = np.int32(2**31 - 1)
LONGEST = 256
CELLS = 1 << 20
CACHED = 600_000
CHUNK_CHARS = 2_000_000
SLAB_PIECES = 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Hash table from a pair of ids to the id of the merged token, by open addressing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray) -> None:
        self.bits = max(4, int(np.ceil(np.log2(4 * max(len(merged), 1)))))
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == -1
            self.keys[at[todo[free]]] = keys[todo[free]]  # of several for one slot, the last stays
            placed = self.keys[at[todo]] == keys[todo]
            self.values[at[todo[placed]]] = merged[todo[placed]]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the merged tokens, NONE where a pair does not merge (or an id is negative)."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        at = self._slots(keys)
        found = self.keys[at]
        result = np.where(found == keys, self.values[at], NONE)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            result[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        result[(left < 0) | (right < 0)] = NONE
        return result


class _Known(dict):
    """Numbers pieces as they are looked up."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        self.new.append(piece)
        return number


class Encoder:
    """A vocabulary of ranks with its pattern; ranks are the ids."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.tokens: dict[int, bytes] = {rank: token for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (left, right, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (left := self.ranks.get(token[:cut])) is not None
            and (right := self.ranks.get(token[cut:])) is not None
        ]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)
        self.pair_rank = {(a, b): c for a, b, c in pairs}
        self.forget()

    def forget(self) -> None:
        self.known = _Known()
        self.known_ids = np.empty(0, np.int32)
        self.known_ends = np.zeros(1, np.int64)  # piece k has the ids from known_ends[k] to known_ends[k + 1]
        self.known_text: list[str] = []

    # --- pieces ---

    def _matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length."""
        width = max(map(len, pieces))
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        lengths = np.array([len(p) for p in pieces])
        tokens = np.where(np.arange(width) < lengths[:, None], self.single[raw], np.int32(-1))
        ranks = self.pairs.find(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(len(pieces), -1)
        row_of, done = np.arange(len(pieces)), [np.empty(0, np.int32)] * len(pieces)
        while len(row_of):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(row_of), np.int64)
            best = ranks[np.arange(len(row_of)), at] if ranks.shape[1] else np.full(len(row_of), NONE)
            over = best == NONE
            if over.any():
                for row, ids in zip(row_of[over].tolist(), tokens[over], strict=True):
                    done[row] = ids[ids >= 0]
                live = ~over
                row_of, tokens, ranks, at, best = row_of[live], tokens[live], ranks[live], at[live], best[live]
                if not len(row_of):
                    break
            n, rows = len(row_of), np.arange(len(row_of))
            tokens[rows, at] = best
            stay = np.ones(tokens.shape, bool)
            stay[rows, at + 1] = False
            tokens = tokens[stay].reshape(n, -1)
            stay = np.ones(ranks.shape, bool)
            stay[rows, at] = False
            ranks = ranks[stay].reshape(n, -1)
            if not ranks.shape[1]:
                continue
            left = at > 0
            ranks[rows[left], at[left] - 1] = self.pairs.find(tokens[rows[left], at[left] - 1], best[left])
            right = at < ranks.shape[1]
            ranks[rows[right], at[right]] = self.pairs.find(best[right], tokens[rows[right], at[right] + 1])
        return done

    def _heap(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece: the same merges in the same order, by linked neighbours and a heap."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        get = self.pair_rank.get
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (r := get((rank, ids[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[after[i]]))
            if (p := before[i]) >= 0 and (r := get((ids[p], rank))) is not None:
                heapq.heappush(heap, (r, p, ids[p], rank))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; a piece that is a token is that token."""
        result: list[np.ndarray | None] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                result[i] = np.array([whole], np.int32)
            elif len(piece) > LONGEST:
                result[i] = self._heap(piece)
            else:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for power, rows in buckets.items():
            step = max(1, CELLS >> power)
            for k in range(0, len(rows), step):
                some = rows[k : k + step]
                for i, ids in zip(some, self._matrix([pieces[i] for i in some]), strict=True):
                    result[i] = ids
        return result

    def _learn(self) -> None:
        """Encodes the pieces that were looked up for the first time."""
        if not (new := self.known.new):
            return
        self.known.new = []
        encoded = self.encode_pieces([p.encode() for p in new])
        self.known_text += [" ".join(map(str, ids.tolist())) for ids in encoded]
        self.known_ids = np.concatenate([self.known_ids, *encoded])
        lengths = np.array([len(ids) for ids in encoded], np.int64)
        self.known_ends = np.concatenate([self.known_ends, self.known_ends[-1] + np.cumsum(lengths)])

    # --- texts ---

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, str]]:
        """Per text its ids, and the same in decimal joined by spaces. Texts are worked on in chunks of bounded size."""
        i = 0
        while i < len(texts):
            chunk, chars = [], 0
            while i < len(texts) and (not chunk or chars + len(texts[i] or "") <= CHUNK_CHARS):
                chars += len(texts[i] or "")
                chunk.append(texts[i] or "")
                i += 1
            if len(chunk) == 1:
                yield self._encode_long(chunk[0])
            else:
                yield from self._lookup([self.pattern.findall(t) for t in chunk])

    def _lookup(self, split: list[list[str]]) -> Iterator[tuple[np.ndarray, str]]:
        """Ids and text of each list of pieces."""
        if len(self.known) > CACHED:
            self.forget()
        at = [list(map(self.known.__getitem__, pieces)) for pieces in split]
        self._learn()
        places = np.fromiter(chain.from_iterable(at), np.int64)
        starts, lengths = self.known_ends[places], self.known_ends[places + 1] - self.known_ends[places]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        flat = self.known_ids[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        bounds = ends[np.concatenate(([0], np.cumsum([len(a) for a in at])))].tolist()
        for some, lo, hi in zip(at, bounds, bounds[1:], strict=False):
            yield flat[lo:hi], " ".join(map(self.known_text.__getitem__, some))

    def _encode_long(self, text: str) -> tuple[np.ndarray, str]:
        found, parts = (m.group() for m in self.pattern.finditer(text)), []
        while slab := list(islice(found, SLAB_PIECES)):
            parts += self._lookup([slab])
        if not parts:
            return np.empty(0, np.int32), ""
        return np.concatenate([p[0] for p in parts]), " ".join(p[1] for p in parts)

    def decode(self, ids: np.ndarray | list[int]) -> bytes:
        """The bytes of the ids; an id that is no token raises KeyError."""
        return b"".join([self.tokens[i] for i in np.asarray(ids).tolist()])


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a worker process."""
    return Encoder(path, pattern)


def encode(df: DataFrame, carry: list[str], path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """``row``, ``ids``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` per row of ``df``.

    ``ids_sha256`` is over the decimal ids joined by one space, ``decoded_sha256`` over the bytes that
    the ids decode to. Without ``with_ids`` the ids stay in the worker.
    """
    rows = df.select(packed(df, carry).alias("row"), F.col("text").alias("text"))
    fields = [
        T.StructField("row", rows.schema["row"].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        try:
            for batch in batches:
                counts, digests, decoded, flat, offsets = [], [], [], [], [0]
                for ids, line in bpe.encode(batch.column(1).to_pylist()):
                    counts.append(len(ids))
                    digests.append(hashlib.sha256(line.encode()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                    if with_ids:
                        flat.append(ids)
                        offsets.append(offsets[-1] + len(ids))
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    values = np.concatenate(flat) if flat else np.empty(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
        finally:
            bpe.forget()  # the worker stays for other tasks, of other stages too

    return rows.mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, carry: list[str], path: str, pattern: str) -> DataFrame:
    """``row`` and ``bytes``: what the column ``ids`` of ``df`` decodes to; null ids give null."""
    rows = df.select(packed(df, carry).alias("row"), F.col("ids").alias("ids"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("bytes", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            texts = [None if ids is None else bpe.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["row", "bytes"])

    return rows.mapInArrow(run, schema)
