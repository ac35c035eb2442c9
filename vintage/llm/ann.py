"""Approximate nearest neighbours by inner product with cross-polytope hashing.

Vectors are put in bands of nearly equal norm. Inner products become angles by one more coordinate,
sqrt(M^2 - |x|^2) for stored vectors (M: the largest norm of their band) and 0 for queries. Each table has its
own pseudo-rotation, three rounds of random signs and a fast Hadamard transform, and hashes a vector to the
signed axis nearest to it. A query probes in every table the axes nearest to it. These do not depend on M,
so all bands share the buckets and all are probed.

Bands of up to ``EXACT`` vectors are not hashed but compared with every query: their few vectors may all matter,
whatever their angles. A query that has found fewer than k neighbours although there are more is compared with
all vectors.

What is found is ranked by exact inner products of the original vectors in double precision, equal ones by id.

Equal vectors are combined first: of their ids only the k + 1 smallest can be among k neighbours, and a
query vector is searched once for all its ids. Vectors of a bucket are kept in blocks of bounded size,
so a bucket of any size is many blocks, met by blocks of queries; a block pair yields the best k
of each query, and these are merged by query.

Defined results: vectors that are null, empty or zero, or hold a null, NaN or infinite component, and
rows with a null id take no part; a query is compared with vectors of its own dimension; rows of the
same id and vector count once, and a query's own id is never among its neighbours; fewer than k
candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.staging import stage

K = 20
QUERY_STEP = 20
TABLES = 12
PROBES = 20
SEED = 7
BLOCK = 512
#: Bands of norms an octave, and up to how many vectors a band is compared as a whole.
BANDS = 4
EXACT = 2048
#: Products that are summed, and hashed rows that are made, at a time.
STEP = 1 << 15
HASHED_ROWS = 20_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row (width a power of two), scaled to keep lengths."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def axes(vectors: np.ndarray, extra: np.ndarray, tables: int, probes: int) -> np.ndarray:
    """(rows, tables, probes): the signed axes nearest to each row after each table's rotation, nearest first."""
    n, d = vectors.shape
    width = 1 << int(np.ceil(np.log2(d + 1)))
    padded = np.zeros((n, width))
    padded[:, :d], padded[:, d] = vectors, extra
    signs = np.random.default_rng([SEED, width]).choice([-1.0, 1.0], (tables, 3, width))
    result = np.empty((n, tables, min(probes, 2 * width)), np.int32)
    for t in range(tables):
        rotated = padded
        for s in signs[t]:
            rotated = hadamard(rotated * s)
        both = np.concatenate([rotated, -rotated], axis=1)
        result[:, t] = np.argsort(-both, axis=1, kind="stable")[:, : result.shape[2]]
    return result


def _hashed(df: DataFrame, probes: int, tables: int, stored: bool) -> DataFrame:
    """(rep, first, vector, d, t, bucket) for each row of ``df``: its axes. ``largest`` is the largest norm of a stored vector's band."""

    step = max(1, HASHED_ROWS // (tables * probes))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, alike in frame.groupby("d", sort=False):
                for same in (alike.iloc[i : i + step] for i in range(0, len(alike), step)):
                    x = np.stack(same["vector"].to_list()).astype(np.float64) / same["largest"].to_numpy()[:, None]
                    extra = np.sqrt(np.maximum(1 - (x**2).sum(1), 0)) if stored else np.zeros(len(x))
                    found = axes(x, extra, tables, probes)
                    n, k = len(x), found.shape[2]
                    yield pd.DataFrame(
                        {
                            "rep": np.repeat(same["rep"].to_numpy(), tables * k),
                            "first": np.repeat(same["first"].to_numpy(), tables * k),
                            "vector": np.repeat(np.fromiter((v for v in same["vector"]), object, n), tables * k),
                            "d": np.int32(x.shape[1]),
                            "t": np.tile(np.repeat(np.arange(tables, dtype=np.int32), k), n),
                            "bucket": found.ravel(),
                        }
                    )

    rows = df.select("rep", "first", "vector", "d", "largest")
    return rows.mapInPandas(run, "rep long, first long, vector array<double>, d int, t int, bucket int")


def _blocks(rows: DataFrame, prefix: str, by: list[str]) -> DataFrame:
    """Rows alike in ``by`` in blocks of about BLOCK rows: (by, ids, firsts, vectors)."""
    # Staged, its size is known, so that the rows need not be shuffled to meet it.
    sizes = stage(rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks")))
    dealt = rows.join(sizes, by).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n_blocks")))
    return dealt.groupBy(*by, "block").agg(F.collect_list(F.struct("rep", "first", "vector")).alias("rows")).select(
        *by,
        F.col("rows.rep").alias(f"{prefix}_ids"),
        F.col("rows.first").alias(f"{prefix}_firsts"),
        F.flatten(F.col("rows.vector")).alias(f"{prefix}_vectors"),
    )


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner product of each row of ``a`` and of ``b``: the sum of products in order."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _best(k: int):
    """Per pair of blocks the best ``k`` of each query by score and first id, as an array of (query, rep, first, score).

    Matrix products differ from sums in order in the last bits, so they only choose what can be among
    the best, with slack for all rounding; sums in order settle it.
    """

    @F.pandas_udf("struct<query: array<long>, rep: array<long>, first: array<long>, score: array<double>>")
    def of(q_ids: pd.Series, q_vectors: pd.Series, c_ids: pd.Series, c_firsts: pd.Series, c_vectors: pd.Series) -> pd.DataFrame:
        out: dict[str, list] = {"query": [], "rep": [], "first": [], "score": []}
        for qi, qv, ci, cf, cv in zip(q_ids, q_vectors, c_ids, c_firsts, c_vectors, strict=True):
            qi, ci, cf = np.asarray(qi), np.asarray(ci), np.asarray(cf)
            qv, cv = np.asarray(qv, np.float64).reshape(len(qi), -1), np.asarray(cv, np.float64).reshape(len(ci), -1)
            if len(ci) > k:
                rough = qv @ cv.T
                slack = 8 * qv.shape[1] * np.finfo(float).eps * np.linalg.norm(qv, axis=1) * np.linalg.norm(cv, axis=1).max()
                q, c = np.nonzero(rough >= np.partition(rough, -k, axis=1)[:, -k, None] - slack[:, None])
            else:
                q, c = (a.ravel() for a in np.indices((len(qi), len(ci))))
            score = np.concatenate([_products(qv[q[i : i + STEP]], cv[c[i : i + STEP]]) for i in range(0, len(q), STEP)])
            order = np.lexsort((ci[c], cf[c], -score, q))
            order = order[np.arange(len(q)) - np.searchsorted(q, q) < k]  # q ascends, in any order within it
            out["query"].append(qi[q[order]])
            out["rep"].append(ci[c[order]])
            out["first"].append(cf[c[order]])
            out["score"].append(score[order])
        return pd.DataFrame(out)

    return of


def _scored(pairs: DataFrame, k: int) -> DataFrame:
    """(query, rep, first, score) of pairs of blocks, the best ``k`` of each."""
    best = pairs.select(_best(k)("q_ids", "q_vectors", "c_ids", "c_firsts", "c_vectors").alias("best"))
    return best.select(F.explode(F.arrays_zip("best.query", "best.rep", "best.first", "best.score")).alias("p")).select("p.*")


def _all_pairs(asking: DataFrame, stored: DataFrame) -> DataFrame:
    """All pairs of blocks of one dimension. Not an equi-join, as one dimension would be one task."""
    left = asking.withColumnRenamed("d", "q_d")
    return left.crossJoin(stored).filter(F.abs(F.col("q_d") - F.col("d")) < 1)


def _lists(scored: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """(query, near): the best ``k`` ids of each query, an array of (place, vec_id, score).

    Equal vectors are cut by their first ids, each of which is an id, so no id among the best is lost.
    """
    by_vector = Window.partitionBy("query").orderBy(F.col("score").desc(), "first", "rep")
    by_id = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    once = scored.groupBy("query", "rep").agg(F.max("first").alias("first"), F.max("score").alias("score"))
    kept = once.withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= k).select("query", "rep", "score")
    return (
        kept.join(vectors.select("rep", "ids"), "rep")
        .select("query", "score", F.explode("ids").alias("vec_id"))
        .withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    )


def _norm(vector: str) -> Column:
    """The length of a vector that is not zero, finite whatever its size."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x)))
    scaled = F.transform(F.arrays_zip(F.col(vector), F.array_repeat(largest, F.size(vector))), lambda p: p[vector] / p["1"])
    return F.least(largest * F.sqrt(F.aggregate(scaled, F.lit(0.0), lambda s, x: s + x * x)), F.lit(sys.float_info.max))


def neighbours(
    df: DataFrame, queries: Column, k: int = K, tables: int = TABLES, probes: int = PROBES, exact: int = EXACT
) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``df`` (vec_id, embedding) that ``queries`` picks."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    rows = stage(
        df.filter(usable).select(
            F.col("vec_id").cast("long").alias("id"), vector.alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")
        )
    )
    # Of equal vectors, the smallest ids; the first names the vector.
    order = Window.partitionBy("vector").orderBy("id")
    smallest = (
        rows.select("vector", "id")
        .distinct()
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    vectors = stage(
        smallest.select(
            "vector", "ids", F.get("ids", F.lit(0)).alias("first"), F.size("vector").alias("d"), _norm("vector").alias("norm"),
            F.monotonically_increasing_id().alias("rep"),
        ).withColumn("band", F.round(F.log2("norm") * BANDS).cast("int"))
    )
    bands = stage(vectors.groupBy("d", "band").agg(F.max("norm").alias("largest"), F.count(F.lit(1)).alias("n")))
    banded = vectors.join(bands, ["d", "band"])
    asked = stage(rows.filter("asks").select("id", "vector").distinct().join(vectors.drop("ids", "band"), "vector"))
    heads = stage(asked.select("rep", "first", "vector", "d", F.col("norm").alias("largest")).dropDuplicates(["rep"]))
    bucket = ["d", "t", "bucket"]
    stored = _blocks(stage(_hashed(banded.filter(F.col("n") > exact), 1, tables, True)), "c", bucket)
    probing = _blocks(stage(_hashed(heads, probes, tables, False)), "q", bucket)
    few = _blocks(banded.filter(F.col("n") <= exact), "c", ["d"])
    pairs = [probing.join(stored, bucket), _all_pairs(_blocks(heads, "q", ["d"]), few)]
    lists = stage(_lists(_scored(pairs[0], k + 1).union(_scored(pairs[1], k + 1)), vectors, k + 1))
    # Queries that found too little, to be compared with all.
    there = stage(vectors.groupBy("d").agg(F.sum(F.size("ids")).alias("n_there")))
    known = lists.select(F.col("query").alias("rep"), F.size("near").alias("n_found"))
    lacking = F.coalesce("n_found", F.lit(0)) < F.least(F.col("n_there"), F.lit(k + 1))
    short = stage(heads.join(known, "rep", "left").join(there, "d").filter(lacking).select(heads.columns))
    if not short.isEmpty():
        completed = _all_pairs(_blocks(short, "q", ["d"]), _blocks(vectors, "c", ["d"]))
        rest = lists.join(short.select(F.col("rep").alias("query")), "query", "left_anti")
        lists = rest.unionByName(_lists(_scored(completed, k + 1), vectors, k + 1))
    answers = asked.select("id", F.col("rep").alias("query")).join(lists, "query")
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("id")), 1, k)
    return answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score"
    )
