"""SimHash near-duplicates by a generalised pigeonhole over correlated bits.

A 64-bit fingerprint is cut into parts with thresholds t_i, the sum of t_i + 1 being one more than
the distance asked for. Two fingerprints within that distance then agree on some part up to its
threshold, so probing each part with all values within its threshold finds every link. Correlated bits
share a part, and a dynamic program spends the thresholds where the estimated number of probes and
candidates is least. The plan affects the cost alone, never the links found.

Equal fingerprints are combined first, so copies cost nothing, and links run between different
fingerprints only.

Defined results: a null text is the empty text; texts without words have fingerprint 0 and link like
any other; rows with a null id link, and an id of a component is its smallest not null (null if none);
repeated rows each keep their row; an empty table gives an empty result. Texts are hashed whole, very long ones in
slabs of shingles; columns outside ``carry`` are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.components import components
from vintage.llm.staging import packed, stage

BITS = 64
SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Cost of shuffling a probe, in candidates compared.
PROBE_COST = 10.0
_SLAB = 8192


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit integer."""
    tokens = text.encode().lower().split() if text else []  # bytes: only ASCII letters and ASCII white space
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(line, SEED)).astype(np.int64))
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _SLAB):
        spans = zip(starts[at : at + _SLAB], stops[at : at + _SLAB], strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text)


# --- the plan: parts and thresholds ---


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints, and how many have bits i and j set, over all of them (64 x 64 numbers)."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            for at in range(0, len(values), _SLAB):
                raw = np.ascontiguousarray(values[at : at + _SLAB]).view(np.uint8).reshape(-1, 8)
                x = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
                gram += x.T @ x
            n += len(values)
        place = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(np.append(gram.ravel(), n).astype(np.int64))], names=["place", "n"]
        )

    sums = prints.select("fp").mapInArrow(grams, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    flat = np.zeros(BITS * BITS + 1)
    for r in sums.collect():
        flat[r["place"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def parts_of(correlation: np.ndarray, m: int) -> list[list[int]]:
    """``m`` parts of near equal width: each starts from a free bit and takes the free bits most correlated with it."""
    free, parts = set(range(BITS)), []
    for k in range(m):
        width = BITS // m + (k < BITS % m)
        ties = correlation.sum(1)
        part = [max(sorted(free), key=lambda b: ties[b])]
        free.remove(part[0])
        while len(part) < width:
            best = max(sorted(free), key=lambda b: correlation[b, part].sum())
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def allocate(parts: list[list[int]], means: np.ndarray, n: int, distance: int) -> tuple[float, list[int]]:
    """Thresholds of least estimated cost with a sum of (t + 1) of ``distance`` + 1; -1 leaves a part out."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in parts:
        differ = 2 * means[part] * (1 - means[part])
        within = np.array([1.0])  # chances of 0, 1, ... differing bits, bits taken as independent
        for d in differ:
            within = np.convolve(within, [1 - d, d])
        chance = np.cumsum(within)
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, min(distance - spent, len(part) - 1) + 1):
                probes = sum(math.comb(len(part), k) for k in range(t + 1))
                more = PROBE_COST * n * (probes + 1) + n * n * chance[t] / 2 if t >= 0 else 0.0
                if spent + t + 1 not in step or cost + more < step[spent + t + 1][0]:
                    step[spent + t + 1] = (cost + more, [*chosen, t])
        best = step
    return best[distance + 1]


def plan(n: int, gram: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe."""
    n = max(n, 1)
    means = np.diag(gram) / n
    spread = np.sqrt(np.maximum(means * (1 - means), 1e-12))
    correlation = np.abs((gram / n - np.outer(means, means)) / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0)
    options = []
    for m in range(2, distance + 2):
        parts = parts_of(correlation, m)
        cost, chosen = allocate(parts, means, n, distance)
        options.append((cost, m, [(p, t) for p, t in zip(parts, chosen, strict=True) if t >= 0]))
    return min(options, key=lambda o: o[:2])[2]


def _signed(bits: tuple[int, ...] | list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v), u < v: all pairs of different fingerprints (column fp, distinct) within ``distance`` bits."""
    n, gram = bit_counts(prints)
    chosen = plan(n, gram, distance)
    masks = F.array(*(F.struct(F.lit(k).alias("part"), F.lit(_signed(bits)).alias("mask")) for k, (bits, _) in enumerate(chosen)))
    flips = [
        F.struct(F.lit(k).alias("part"), F.lit(_signed(bits)).alias("mask"), F.lit(_signed(flip)).alias("flip"))
        for k, (bits, t) in enumerate(chosen)
        for size in range(t + 1)
        for flip in itertools.combinations(bits, size)
    ]
    index = prints.select(F.col("fp").alias("v"), F.explode(masks).alias("p")).select(
        "v", F.col("p.part").alias("part"), F.col("v").bitwiseAND(F.col("p.mask")).alias("key")
    )
    probes = prints.select(F.col("fp").alias("u"), F.explode(F.array(*flips)).alias("p")).select(
        "u", F.col("p.part").alias("part"), F.col("u").bitwiseAND(F.col("p.mask")).bitwiseXOR(F.col("p.flip")).alias("key")
    )
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    return probes.join(index, ["part", "key"]).filter((F.col("u") < F.col("v")) & near).select("u", "v").distinct()


def classes(df: DataFrame, carry: list[str], shingle: int = SHINGLE, distance: int = DISTANCE) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` as (row, fp, rid), and per fingerprint (fp, first): the first row of its class.

    ``first`` is a struct of (no_id, doc_id, rid), the smallest in the class: null ids come last.
    """
    rows = stage(
        df.select(
            packed(df, carry).alias("row"),
            F.col("doc_id").cast("long").alias("id"),
            fingerprints(F.col("text"), shingle).alias("fp"),
            F.monotonically_increasing_id().alias("rid"),
        )
    )
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("doc_id"), F.col("rid").alias("rid"))
    prints = stage(rows.groupBy("fp").agg(F.min(order).alias("first")))
    members = stage(components(links(prints, distance)))
    linked = prints.join(members, prints["fp"] == members["node"]).select("fp", "root", "first")
    heads = linked.groupBy("root").agg(F.min("first").alias("head"))
    merged = linked.select("fp", "root").join(heads, "root").select(F.col("fp").alias("of"), "head")
    firsts = prints.join(merged, F.col("fp") == F.col("of"), "left").select(
        "fp", F.coalesce("head", "first").alias("first")
    )
    # Staged, so that joins with the rows shuffle both sides, and a fingerprint of many rows can be split.
    return rows, stage(firsts)


def near_duplicates(df: DataFrame, carry: list[str], shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``row``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row of ``df``."""
    rows, firsts = classes(df, carry, shingle, distance)
    ids = firsts.select("fp", F.col("first.doc_id").alias("component_id"))
    return rows.select("row", "fp").join(ids, "fp").select(
        "row", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each class of ``docs``, the one with the smallest id, with its columns."""
    rows, firsts = classes(docs, docs.columns, shingle, distance)
    kept = firsts.select(F.col("first.rid").alias("rid")).distinct()
    return rows.join(kept, "rid", "left_semi").select("row.*")
