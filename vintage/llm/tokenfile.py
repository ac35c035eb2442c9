"""Token ids as blocks of Simple-8b words.

A 64-bit word holds a selector in its upper 4 bits and, in the others, as many ids as the selector says,
all of one width, the first id lowest. Selector 0 is an escape: the next word is one id as it is.
Selectors 1 to 14 hold 60 ids of 1 bit down to 1 id of 60 bits. The last word of a block may be filled
up with zeros; the block's number of ids tells.

A block holds whole documents. Its payload is a header (magic, version, ids, words, stride), the number
of ids before every ``stride``-th word, and the words, all little-endian. So any part of a block is
decoded on its own, and all words of a selector at once. Blocks are rows of a Parquet table, which any
store that Spark writes to can hold, with the part and its place, the documents' ids and their lengths.

Defined results: a null text is the empty text, which has the end id only; null document ids come first;
equal ids are ordered by text; repeated rows each keep their ids; an empty table gives no blocks.
"""

from __future__ import annotations

import os
import string
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice
from itertools import count as numbers

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vintage.llm.staging import scratch, stage

#: Selector - 1 -> ids a word, bits an id.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = 60 // COUNTS
ESCAPE = 0
MAGIC, VERSION, STRIDE = 0x62385653, 1, 1024
BLOCK_IDS = 1 << 18
END_ID = 2
CACHED_WORDS, CACHED_PARTS = 600_000, 1_000_000
BATCH_BYTES = 2_000_000
GROUP = 500
BLOCKS = "part int, place long, before long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


# --- the code ---


def pack(ids: np.ndarray) -> bytes:
    """The payload of a block."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    # Of each id, the first width that holds it; floats may round an id of over 53 bits up, never down.
    need = np.searchsorted(WIDTHS, np.arange(66)).astype(np.uint8)[np.frexp(ids.astype(np.float64))[1]]
    selector = np.full(n, ESCAPE, np.uint8)  # of the word that would start at each position
    widest = {1: need}  # of this many ids from each position on; behind the last id, zeros fill up
    for s in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[s])
        if count > 1:
            half = max(c for c in widest if 2 * c >= count)
            both = max(0, n - count + half)
            widest[count] = widest[half].copy()
            np.maximum(widest[half][:both], widest[half][count - half :], out=widest[count][:both])
        selector[widest[count] <= s] = s + 1
    step = np.append(1, COUNTS)[selector]
    starts, jump, at = [], step.tolist(), 0
    while at < n:
        starts.append(at)
        at += jump[at]
    starts = np.array(starts, np.int64)
    chosen = selector[starts].astype(np.int64)
    place = np.arange(len(starts)) + np.cumsum(chosen == ESCAPE) - (chosen == ESCAPE)
    words = np.zeros(len(starts) + int((chosen == ESCAPE).sum()), np.uint64)
    words[place] = chosen.astype(np.uint64) << np.uint64(60)
    words[place[chosen == ESCAPE] + 1] = ids[starts[chosen == ESCAPE]]
    padded = np.append(ids, np.zeros(int(COUNTS[0]), np.uint64))
    for s, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist(), strict=True)):
        mine = chosen == s + 1
        if mine.any():
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
            words[place[mine]] |= np.bitwise_or.reduce(padded[starts[mine][:, None] + np.arange(count)] << shifts, axis=1)
    counts = np.zeros(len(words), np.int64)
    counts[place + (chosen == ESCAPE)] = np.where(chosen == ESCAPE, 1, COUNTS[chosen - 1])
    before = np.concatenate(([0], np.cumsum(counts)))[: len(words) : STRIDE]
    header = np.array([MAGIC, VERSION, n, len(words), STRIDE], "<u8")
    return header.tobytes() + before.astype("<u8").tobytes() + words.astype("<u8").tobytes()


def unpack(payload: bytes) -> np.ndarray:
    """All ids of a payload."""
    values = np.frombuffer(payload, "<u8")
    magic, version, n, n_words, stride = values[:5].tolist()
    if (magic, version) != (MAGIC, VERSION):
        raise ValueError("not a block of this format")
    n_offsets = -(-n_words // stride)
    before, words = values[5 : 5 + n_offsets].astype(np.int64), values[5 + n_offsets : 5 + n_offsets + n_words]
    if len(words) != n_words:
        raise ValueError("a block is cut short")
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = _behind_escapes(words, selector)
    counts = np.where(raw, 1, np.where(selector == ESCAPE, 0, np.append(COUNTS, 0)[selector - 1]))
    # Within a stride, places follow from its own counts, on top of the stored offset.
    running = np.cumsum(counts) - counts
    strides = np.arange(n_words) // stride
    start = running - running[strides * stride] + before[strides] if n_words else running
    ids = np.zeros(n + int(COUNTS[0]), np.uint64)
    ids[start[raw]] = words[raw]
    for s, (count, width) in enumerate(zip(COUNTS.tolist(), WIDTHS.tolist(), strict=True)):
        mine = np.flatnonzero((selector == s + 1) & ~raw)
        if len(mine):
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(width)
            values = (words[mine][:, None] >> shifts) & np.uint64((1 << width) - 1)
            ids[start[mine][:, None] + np.arange(count)] = values
    return ids[:n]


def _behind_escapes(words: np.ndarray, selector: np.ndarray) -> np.ndarray:
    """Which words are ids as they are. A raw word may look like an escape itself, so runs are walked."""
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == ESCAPE).tolist():
        if not raw[at]:
            raw[at + 1] = True
    return raw


# --- tokens ---


def _listed(keys: pa.Array) -> list[bytes]:
    # By way of NumPy, several times as fast as to_pylist.
    return keys.view(pa.binary()).to_numpy(zero_copy_only=False).tolist()


class Ids:
    """Lists of ids by key, in one array. Keys are numbered when looked up, and their ids added in that order."""

    def __init__(self) -> None:
        self.known: defaultdict[bytes, int] = defaultdict(numbers().__next__)
        self.learned = 0
        self.ids, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def places(self, keys: pa.Array) -> np.ndarray:
        """The number of each key. Repeated keys are found by Arrow, so that each is looked up once."""
        coded = keys.dictionary_encode()
        distinct = _listed(coded.dictionary)
        found = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return found[coded.indices.to_numpy()]

    def take_new(self) -> list[bytes]:
        new = list(islice(reversed(self.known), len(self.known) - self.learned))[::-1]
        self.learned = len(self.known)
        return new

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])

    def get(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids at all places, one after another, and where each place's ids end."""
        lengths = self.ends[places + 1] - self.ends[places]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return self.ids[np.repeat(self.ends[places] - ends[:-1], lengths) + np.arange(ends[-1])], ends


class WordTokenizer:
    """A tokenizer of the tokenizers library whose tokens never cross ASCII white space, with caches.

    New words are cut in front of closing ASCII punctuation behind a letter or digit, where the tokenizer
    cuts too, and ASCII words are lower-cased, as it does, but for those that may hold an added token; the library encodes each such part once.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.parts = Ids(), Ids()

    def _encode_parts(self, parts: list[bytes]) -> None:
        """Parts are joined to save calls, and told apart by the place of their ids."""
        groups = [[p.decode() for p in parts[i : i + GROUP]] for i in range(0, len(parts), GROUP)]
        ids, lengths = [], []
        for group, e in zip(groups, self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            stops = np.cumsum([len(p) + 1 for p in group])
            starts = np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * len(e))[::2]
            ids.append(np.array(e.ids, np.int32))
            lengths.append(np.bincount(np.searchsorted(stops, starts, "right"), minlength=len(group)))
        self.parts.add(np.concatenate(ids), np.concatenate(lengths))

    def _learn(self, words: list[bytes]) -> None:
        if len(self.parts.known) > CACHED_PARTS:
            self.parts = Ids()
        words = pa.array(words, pa.binary()).view(pa.string())
        # Added tokens are looked for in the text as it is, so what may hold one is neither cut nor lower-cased.
        as_it_is = pc.match_substring(words, "<|")
        plain = pc.if_else(pc.and_not(pc.string_is_ascii(words), as_it_is), pc.ascii_lower(words), words)
        base = pc.ascii_rtrim(plain, characters=string.punctuation)
        kept = pc.binary_length(base)
        ends = pc.and_(pc.less(kept, pc.binary_length(plain)), pc.match_substring_regex(base, "[0-9A-Za-z]$"))
        cut = pc.and_not(ends, as_it_is)
        at = np.flatnonzero(cut.to_numpy(zero_copy_only=False))
        whole = zip(_listed(plain.take(pa.array(at))), kept.to_numpy()[at].tolist(), strict=True)
        closing = pa.array([word[n:] for word, n in whole], pa.binary()).view(pa.string())
        # Of a word that is cut, both parts one after the other.
        order = np.insert(np.arange(len(words)), at + 1, len(words) + np.arange(len(at)))
        flat = pa.concat_arrays([pc.if_else(cut, base, plain), closing]).take(pa.array(order))
        counts = np.ones(len(words), np.int64)
        counts[at] = 2
        places = self.parts.places(flat)
        if new := self.parts.take_new():
            self._encode_parts(new)
        ids, ends = self.parts.get(places)
        self.words.add(ids, np.diff(ends[np.concatenate(([0], np.cumsum(counts)))]))

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8), and how many each has."""
        # White space at either end of a text leaves an empty word, which gives no ids.
        split = pc.ascii_split_whitespace(pa.array([t or b"" for t in texts], pa.binary()).view(pa.string()))
        if len(self.words.known) > CACHED_WORDS:
            self.words = Ids()
        places = self.words.places(split.flatten())
        if new := self.words.take_new():
            self._learn(new)
        flat, ends = self.words.get(places)
        return flat, np.diff(ends[split.offsets.to_numpy()])


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of a worker process; Spark's tasks are what runs in parallel."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokenizer(path)


def _chunks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with a bounded number of bytes, a longer text alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text or b"") > BATCH_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text or b"")
    if texts:
        yield start, len(texts)


def write(df: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of all texts of ``df`` (doc_id, text) in ascending order of doc_id to the table at ``path``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokenizer(vocabulary).encode, TaskContext.get().partitionId()
        place, before, doc_ids, lengths, ids, size = 0, 0, [], [], [], 0

        def block() -> pa.RecordBatch:
            row = [part, place, before, size, doc_ids, np.concatenate(lengths), pack(np.concatenate(ids))]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SCHEMA, strict=True)], schema=_SCHEMA)

        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for lo, hi in _chunks(texts):
                flat, counts = encode(texts[lo:hi])
                flat = np.insert(flat, np.cumsum(counts), end_id)
                ends = np.concatenate(([0], np.cumsum(counts + 1)))
                at = 0
                while at < hi - lo:
                    # Up to the document that fills the block.
                    to = min(int(np.searchsorted(ends, ends[at] + block_ids - size)), hi - lo)
                    doc_ids, size = doc_ids + docs[lo + at : lo + to], size + int(ends[to] - ends[at])
                    lengths.append(counts[at:to] + 1)
                    ids.append(flat[ends[at] : ends[to]])
                    at = to
                    if size >= block_ids:
                        yield block()
                        place, before = place + 1, before + size
                        doc_ids, lengths, ids, size = [], [], [], 0
        if size:
            yield block()

    keyed = df.select("doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("copy"))
    order = [F.col("doc_id").asc_nulls_first(), "tie", "copy"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col("doc_id").cast("long"), "text")
    ordered.mapInArrow(blocks, BLOCKS).write.parquet(path)


_SCHEMA = pa.schema(
    [
        ("part", pa.int32()), ("place", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary()),
    ]
)


def read(spark, path: str) -> DataFrame:
    """Blocks with ``start``, the ids in front of each. Sums run over one row a part."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))
    # Staged, its size is known, so that the blocks need not be shuffled to meet it.
    return blocks.join(stage(offsets), "part").withColumn("start", F.col("offset") + F.col("before"))


def documents(blocks: DataFrame, with_ids: bool = False) -> DataFrame:
    """Per document of ``read``'s blocks: doc_id, start, n_tokens, ids_crc32 (of its ids as little-endian 32-bit numbers), ids."""
    ids_type = ", ids array<long>" if with_ids else ""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, lengths = batch.column(0)[row].as_py(), batch.column(2)[row].values.to_numpy()
                ids = unpack(batch.column(3)[row].as_py())
                if len(ids) != lengths.sum():
                    raise ValueError("a block's ids don't match its documents")
                ends = np.cumsum(lengths)
                raw = memoryview(ids.astype("<u4").tobytes())
                bounds = zip((ends - lengths).tolist(), ends.tolist(), strict=True)
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in bounds]
                columns = [batch.column(1)[row].values, pa.array(start + ends - lengths), pa.array(lengths), pa.array(crcs, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = pa.array(np.append(0, ends).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocks.select("start", "doc_ids", "lengths", "payload").mapInArrow(
        decode, f"doc_id long, start long, n_tokens long, ids_crc32 long{ids_type}"
    )


def encoded(df: DataFrame, vocabulary: str) -> DataFrame:
    """The documents of ``df`` written to a new table in the shared folder and read back."""
    path = scratch(df.sparkSession)
    write(df, path, vocabulary)
    return documents(read(df.sparkSession, path))
