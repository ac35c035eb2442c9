"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed 60-bit hash. A source's target is whole copies of all its documents plus a
budget, which the documents with hashes below a threshold of that source fill. The threshold comes
from sums of words by hash bucket: the bucket that holds the budget's end is split again, until one
document (or a tie of equal hashes) is left. Nothing is sorted, and the last pass is a filter.

Defined results: a null source is a source, last in order; a null text has size 0; documents equal in
id and text share a hash and are taken together; the tie at the budget's end is taken if that
brings the source nearer to its target; a source of size 0 has target 0. The same table gives the
same mix in every run. A document is taken whole or not at all, so a very long one can put its source off its
target by up to half its size; columns outside ``carry`` are not looked at. The table of sources goes through one task, a row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.llm.staging import packed, stage
from vintage.llm.text import n_words, whole

HASH_BITS = 60
ROUND_BITS = 12


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text: the same in every engine."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), whole(text))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Adds ``target`` to (source, source_size).

    Sources below their cap get a common level times their weight. With sources ordered by
    cap / weight, the level is the largest of what the remaining ones get when all before are at
    their caps.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), place + 1)
    ranked = sizes.withColumn("weight", weight).withColumn("limit", cap * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    total = share * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    return (
        ranked.withColumn("level", level)
        .withColumn("target", F.least("limit", F.max("level").over(everything) * F.col("weight")))
        .select("source", "source_size", "target")
    )


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Adds ``whole`` (copies of every document) and ``cutoff`` (hashes below it get one more) to ``goals``."""
    state = stage(
        goals.withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
        )
        .withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumns({"prefix": F.lit(0).cast("long"), "below": F.lit(0).cast("long")})
        .withColumns({"inside": F.lit(0).cast("long"), "n": F.lit(2).cast("long"), "bits": F.lit(0)})
    )
    shift = HASH_BITS
    while shift > 0 and not state.filter("n > 1").isEmpty():
        outer, shift = shift, shift - ROUND_BITS
        bucket = F.shiftright("hash", shift)
        edges = state.select(F.col("source").alias("of"), "prefix", "below", "budget")
        inside = rows.join(edges, F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("hash", outer) == F.col("prefix")))
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(
            F.sum("size").alias("inside"),
            F.count(F.lit(1)).alias("n"),
            F.first("below").alias("below"),
            F.first("budget").alias("budget"),
        )
        upto = Window.partitionBy("source").orderBy("bucket")
        first = (
            sums.withColumn("upto", F.sum("inside").over(upto) + F.col("below"))
            .filter(F.col("upto") >= F.col("budget"))
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "inside", "n")).alias("at"))
            .select(
                F.col("source").alias("of"),
                F.col("at.bucket").alias("prefix"),
                (F.col("at.upto") - F.col("at.inside")).alias("below"),
                F.col("at.inside").alias("inside"),
                F.col("at.n").alias("n"),
            )
        )
        kept = state.select("source", "source_size", "target", "whole", "budget")
        state = stage(
            kept.join(first, F.col("source").eqNullSafe(F.col("of")), "left")
            .drop("of")
            .withColumn("bits", F.lit(shift))
        )
    nearer = 2 * F.col("below") + F.col("inside") < 2 * F.col("budget")
    cutoff = F.shiftleft(F.col("prefix") + F.when(nearer, 1).otherwise(0), shift)
    return stage(
        state.select("source", "source_size", "target", "whole", F.coalesce(cutoff, F.lit(0).cast("long")).alias("cutoff"))
    )


def mix(
    df: DataFrame,
    carry: list[str],
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """The ``carry`` columns as ``row``, ``size``, ``source_size``, ``target`` and ``copies`` per row of ``df``."""
    rows = stage(
        df.select(
            packed(df, carry).alias("row"),
            F.col("source").alias("source"),
            n_words(F.col("text")).alias("size"),
            document_hash(F.col("doc_id"), F.col("text")).alias("hash"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = thresholds(rows.select("source", "size", "hash"), targets(sizes, weights, share, cap))
    plan = plan.withColumnRenamed("source", "of")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "row",
        "size",
        "source_size",
        "target",
        (F.col("whole") + F.when(F.col("hash") < F.col("cutoff"), 1).otherwise(0)).alias("copies"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    repeated = mix(docs, docs.columns).filter("copies > 0")
    return repeated.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
