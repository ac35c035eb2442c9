"""Ranked lexical search: the k best documents of each item under an integer impact score.

The score of a document is the inner product of its impact vector (one coordinate a term, from the term's
count and the document's length) with the item's vector of term weights. As in LEMP, impact vectors are
ordered by length and cut into buckets. With ``t`` the k-th best score that an item is known to have,

- a bucket is left out for an item if the longest vector in it times the item's length is below ``t``
  (Cauchy-Schwarz);
- inside a bucket the item's terms are taken by falling weight until the remaining ones cannot reach ``t``,
  by the largest coordinate of the bucket or by Cauchy-Schwarz on the rest. Only documents that hold one of
  the terms taken are looked at, and their partial product plus the bound of the rest must reach ``t``;
- what survives is scored in 64-bit integers.

Bounds are compared with a slack and ties are kept, so the result is exact. Buckets run in waves of falling
length, each 16 times larger than the one before; a wave starts from the thresholds of those before it, and
tasks raise their own while they read. How many documents a wave takes changes the speed, never the rows.

Items are taken in blocks of about ``BLOCK_BYTES`` of text. The driver and every task hold one block: its
terms, weights and thresholds. Vectors hold the terms of the block only, as others meet no item.

Defined results: a null or term-less text is no document and no item gets it; an item without terms, or
whose terms no document holds, has no rows. Every row of ``items`` is an item of its own and every row of
``docs`` a document, copies and equal ids included; level scores are ordered by id, a null id last. Texts are
taken whole; a text must fit in a task. Other columns of either table are not read, so names cannot clash.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintage.llm.staging import stage

TOP = 10
#: Items are read in blocks of about this much text.
BLOCK_BYTES = 4 << 20
#: Documents of the first wave, and how many times larger each wave is than the one before.
FIRST_WAVE, GROWTH = 4096, 16
#: Term counts a task takes when vectors are dealt out by length.
PART_TERMS = 1_000_000
#: Entries (items times documents) of a bucket's table of partial products.
BUCKET = 400_000
#: Bounds are floating sums; they may be off by less than this share.
SLACK = 1 + 1e-9

# Letters, digits and all bytes of other code points stay, A-Z are lowered, the rest parts words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Block:
    """Items as flat arrays: terms by falling weight, with what the terms from each place on may add."""

    def __init__(self, texts: list[bytes | None]):
        terms = [dict.fromkeys(terms_of(t)) for t in texts]
        self.vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for own in terms for t in own))}
        self.size = len(texts)
        self._terms = [np.array([self.vocabulary[t] for t in own], np.int64) for own in terms]

    def weigh(self, n_docs: int, df: dict[int, int]) -> None:
        weight = np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(self.vocabulary))],
            np.int64,
        )
        ordered = [t[np.argsort(-weight[t], kind="stable")] for t in self._terms]
        self.lengths = np.array([len(t) for t in ordered], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.item = np.repeat(np.arange(self.size), self.lengths)
        self.term = np.concatenate([*ordered, np.zeros(0, np.int64)])
        self.weight = weight[self.term]
        sums, squares = self._from_here(self.weight.astype(float)), self._from_here(self.weight.astype(float) ** 2)
        self.rest_sum, self.rest_norm = sums, np.sqrt(squares)
        has = self.lengths > 0
        self.norm = np.zeros(self.size)
        self.norm[has] = self.rest_norm[self.starts[:-1][has]]

    def _from_here(self, values: np.ndarray) -> np.ndarray:
        """Per place the sum of an item's values from there to its end."""
        return np.concatenate([*(np.cumsum(v[::-1])[::-1] for v in np.split(values, self.starts[1:-1])), np.zeros(0)])


def _counted(block: Block) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (rid, doc_id, n, terms, counts): counts of the block's terms; n counts all words."""
    vocabulary = block.vocabulary

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n, starts, ids, counts = [], [0], array("i"), array("q")
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                n.append(len(words))
                own = sorted((vocabulary[w], c) for w, c in Counter(words).items() if w in vocabulary)
                ids.extend(i for i, _ in own)
                counts.extend(c for _, c in own)
                starts.append(len(ids))
            starts = pa.array(starts, pa.int32())
            columns = {
                "rid": pa.array(range(row, row + len(n)), pa.int64()),
                "doc_id": batch.column("doc_id"),
                "n": pa.array(n, pa.int64()),
                "terms": pa.ListArray.from_arrays(starts, pa.array(np.asarray(ids))),
                "counts": pa.ListArray.from_arrays(starts, pa.array(np.asarray(counts))),
            }
            row += len(n)
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _lists(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, ...]:
    """Offsets from 0 and the flat values of list columns of equal lengths."""
    starts = batch.column(names[0]).offsets.to_numpy().astype(np.int64)
    flat = []
    for name in names:
        at = batch.column(name).offsets.to_numpy()
        flat.append(batch.column(name).values.to_numpy(zero_copy_only=False)[at[0] : at[-1]].astype(np.int64))
    return starts - starts[0], *flat


def _impacts(n_docs: int, n_words: int):
    """Rows (rid, doc_id, norm, terms, impacts) of documents that hold a term of the block."""

    def run(batches):
        for batch in batches:
            starts, ids, counts = _lists(batch, "terms", "counts")
            length = 10 + (90 * batch.column("n").to_numpy() * n_docs) // n_words
            impact = (1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(length, np.diff(starts)))
            norm = np.sqrt(np.add.reduceat(impact.astype(float) ** 2, starts[:-1]))
            offsets = pa.array(starts, pa.int32())
            columns = {
                "rid": batch.column("rid"),
                "doc_id": batch.column("doc_id"),
                "norm": pa.array(norm),
                "terms": pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                "impacts": pa.ListArray.from_arrays(offsets, pa.array(impact, pa.int32())),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def bucket_pairs(block: Block, level: np.ndarray, norm: np.ndarray, starts: np.ndarray, ids: np.ndarray, impacts: np.ndarray, k: int):
    """(item, document, score) of every pair in a bucket that may be among an item's k best.

    ``level`` holds the k-th best score that each item is known to reach, 0 where it has fewer; a pair whose
    score is below its item's level, or 0, is not returned, one that is level with it is.
    """
    n, v = len(norm), len(block.vocabulary)
    doc = np.repeat(np.arange(n), np.diff(starts))
    bound = np.minimum(impacts.max() * block.rest_sum, norm.max() * block.rest_norm) * SLACK
    # Monotone along an item, so the terms taken are the first ones; none if the whole item cannot reach its level.
    taken = bound >= level[block.item]
    if not taken.any():
        return (np.zeros(0, np.int64),) * 3
    n_taken = np.bincount(block.item[taken], minlength=block.size)
    rest = np.zeros(block.size)
    partly = n_taken < block.lengths
    rest[partly] = bound[(block.starts[:-1] + n_taken)[partly]]
    order = np.argsort(ids, kind="stable")
    by_term = ids[order]
    left = np.searchsorted(by_term, block.term[taken], "left")
    found = np.searchsorted(by_term, block.term[taken], "right") - left
    at = order[_spread(left, found)]
    cell = np.repeat(block.item[taken], found) * n + doc[at]
    partial = np.bincount(cell, np.repeat(block.weight[taken], found) * impacts[at], block.size * n).reshape(block.size, n)
    least = level.astype(float)
    if n >= k:
        least = np.maximum(least, np.partition(partial, n - k, axis=1)[:, n - k])
    item, row = np.nonzero((partial > 0) & ((partial + rest[:, None]) * SLACK >= least[:, None]))
    # Exactly, over all terms of the item: where in the bucket is (document, term)?
    lengths = block.lengths[item]
    place = _spread(block.starts[item], lengths)
    wanted = np.repeat(row, lengths) * v + block.term[place]
    held = doc * v + ids
    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
    added = np.where(held[at] == wanted, block.weight[place] * impacts[at], 0)
    score = np.add.reduceat(added, np.cumsum(lengths) - lengths) if len(item) else np.zeros(0, np.int64)
    kept = (score > 0) & (score >= level[item])
    return item[kept], row[kept], score[kept]


def _best(block: Block, level: np.ndarray, k: int):
    """Rows (item, score, doc_id): the k best of each item among the documents of a task."""

    def run(batches):
        best, known = None, level.copy()
        rows = max(16, BUCKET // block.size)
        for whole in batches:
            schema = pa.schema([("item", pa.int64()), ("score", pa.int64()), ("doc_id", whole.schema.field("doc_id").type)])
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                item, row, score = bucket_pairs(block, known, batch.column("norm").to_numpy(), *_lists(batch, "terms", "impacts"), k)
                if not len(item):
                    continue
                ids = batch.column("doc_id").take(pa.array(row))
                more = pa.table([pa.array(item), pa.array(score), ids], schema)
                best = more if best is None else pa.concat_tables([best, more])
                best = best.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
                items = best.column("item").to_numpy()
                place = np.arange(len(items)) - np.searchsorted(items, items)
                best = best.filter(pa.array(place < k)).combine_chunks()
                last = place == k - 1
                known[items[last]] = np.maximum(known[items[last]], best.column("score").to_numpy()[place[place < k] == k - 1])
        if best is not None:
            yield from best.to_batches()

    return run


def _block(docs: DataFrame, items: DataFrame, rows: list, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    block = Block([None if r["text"] is None else bytes(r["text"]) for r in rows])
    if not block.vocabulary:
        return None
    id_type = docs.schema["doc_id"].dataType
    shape = lambda *more: T.StructType([T.StructField("rid", T.LongType()), T.StructField("doc_id", id_type), *more])
    list_of = lambda name, kind: T.StructField(name, T.ArrayType(kind))
    counts = shape(T.StructField("n", T.LongType()), list_of("terms", T.IntegerType()), list_of("counts", T.LongType()))
    counted = stage(docs.mapInArrow(_counted(block), counts))
    n_docs, n_words, n_terms = counted.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.size("terms")), F.lit(0))
    ).first()
    if not n_terms:
        return None
    # A row a term of the block.
    df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    block.weigh(n_docs, df)
    if not block.norm.any():
        return None
    vectors = shape(T.StructField("norm", T.DoubleType()), list_of("terms", T.IntegerType()), list_of("impacts", T.IntegerType()))
    placed = counted.where(F.size("terms") > 0).mapInArrow(_impacts(n_docs, n_words), vectors)
    parts = max(spark.sparkContext.defaultParallelism, n_terms // PART_TERMS)
    # The row number splits a length that many copies share.
    by_length = [F.col("norm").desc(), F.col("rid")]
    placed = stage(placed.repartitionByRange(parts, *by_length).sortWithinPartitions(*by_length))

    waves = [FIRST_WAVE * GROWTH**i for i in range(64) if FIRST_WAVE * GROWTH**i < n_docs]
    shares = [F.lit(1 - w / n_docs) for w in waves]
    ends = placed.agg(F.percentile_approx("norm", F.array(*shares))).first()[0] if waves else []
    found_type = T.StructType([T.StructField("item", T.LongType()), T.StructField("score", T.LongType()), T.StructField("doc_id", id_type)])
    ranked = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    level, best, above = np.zeros(block.size, np.int64), None, math.inf
    for end in [*sorted(set(ends), reverse=True), -1.0]:
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.nanmin(np.where(block.norm > 0, level / block.norm, np.nan)) / SLACK
        wave = placed.where((F.col("norm") <= above) & (F.col("norm") > end) & (F.col("norm") >= float(least)))
        found = wave.mapInArrow(_best(block, level, k), found_type)
        found = found if best is None else best.drop("rank").unionByName(found)
        best = stage(found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k))
        for row in best.where(F.col("rank") == k).select("item", "score").collect():
            level[row["item"]] = row["score"]
        above = end
    named = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", items.schema["item_id"].dataType)])
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], named)
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text) of every item (item_id, text)."""
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    items = items.select("item_id", F.col("text").cast("binary").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = size // BLOCK_BYTES + 1
    items = stage(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))))
    result = None
    for b in range(blocks):
        found = _block(docs, items, items.where(F.col("block") == b).collect(), k)
        if found is not None:
            result = found if result is None else result.unionByName(found)
    if result is None:
        shape = [items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())]
        return docs.sparkSession.createDataFrame([], T.StructType(shape))
    return result
