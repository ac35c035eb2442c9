import re

from helpers import plan
from pyspark.sql import functions as F

from vintage.functions import skew
from vintage.operators import paging
from vintage.operators.paging import build_pages, page, page_after, stored_page

ORDER = ("period", "id")


def table(spark, n=1000):
    """A third of the rows share one period; the order is unique through the id."""
    return spark.range(n).select(
        F.date_add(F.lit("2026-01-01"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20).cast("int")).alias("period"),
        ((F.col("id") * 7919) % n).alias("id"),
    )


def test_pages_cover_everything_in_order(spark):
    df = table(spark)
    want = sorted(tuple(r) for r in df.collect())
    got = [page(df, ORDER, 300, n, slice_rows=150).collect() for n in range(5)]
    assert [len(p) for p in got] == [300, 300, 300, 100, 0]
    assert [tuple(r) for p in got for r in p] == want


def test_null_keys_come_first_and_none_is_lost(spark):
    df = table(spark, 100).select(F.when(F.col("id") % 5 > 1, F.col("period")).alias("period"), "id")
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r))
    for slice_rows in (10, 10**6):
        got = [tuple(r) for n in range(11) for r in page(df, ORDER, 10, n, slice_rows).collect()]
        assert got == want
    followed, last = [], None
    while rows := page_after(df, ORDER, 30, last).collect():
        followed, last = followed + [tuple(r) for r in rows], rows[-1]
    assert followed == want


def test_front_page_is_a_top_k_and_later_ones_push_the_period(spark, tmp_path):
    table(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    first = page_after(df, ORDER, 5, None)
    assert "TakeOrderedAndProject" in plan(first)
    assert "GreaterThanOrEqual(period" in plan(page_after(df, ORDER, 5, first.collect()[-1]))


def test_stored_pages_read_index_and_slice_only(spark, tmp_path):
    df = table(spark).select(F.when(F.col("id") % 5 > 1, F.col("period")).alias("period"), "id", F.lit("x").alias("more"))
    path = str(tmp_path / "pages")
    build_pages(df, ORDER, path, slice_rows=150)
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r))
    for size in (70, 300, 2000):
        got = [stored_page(spark, path, ORDER, size, n).collect() for n in range(1000 // size + 2)]
        assert [tuple(r) for p in got for r in p] == want and got[-1] == []
    second = stored_page(spark, path, ORDER, 50, 1)
    assert len(spark.read.parquet(f"{path}/rows").select("_slice").distinct().collect()) >= 6
    picked = re.search(r"PartitionFilters: \[(?:isnotnull\(_slice#\d+\), )?\(?_slice#\d+ (?:= (\d+)|IN \(([\d,]+)\))", plan(second))
    assert picked and len((picked[1] or picked[2]).split(",")) <= 2 and "Window" not in plan(second)
    build_pages(df.limit(0), ORDER, f"{path}-empty")
    assert stored_page(spark, f"{path}-empty", ORDER, 10, 0).count() == 0


def test_a_small_slice_size_makes_a_bounded_number_of_stored_slices(spark, tmp_path, monkeypatch):
    """A slice is a task and a folder: their number must not grow with the table over a small ``slice_rows``."""
    monkeypatch.setattr(skew, "SLICES", 7)
    df = table(spark).select(F.when(F.col("id") % 5 > 1, F.col("period")).alias("period"), "id")
    path = str(tmp_path / "pages")
    build_pages(df, ORDER, path, slice_rows=4)
    assert 1 < spark.read.parquet(f"{path}/rows").select("_slice").distinct().count() <= 7
    want = sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r))
    for size in (130, 600):  # within a slice, across two, and over several whole ones
        got = [stored_page(spark, path, ORDER, size, n) for n in range(1000 // size + 2)]
        assert [tuple(r) for p in got for r in p.collect()] == want
        assert all(p.columns == df.columns for p in got)


def test_a_page_is_found_through_a_bounded_number_of_slices(spark, monkeypatch):
    monkeypatch.setattr(skew, "SLICES", 7)
    cut, whole = [], paging.pin

    def pinned(df):
        cut.append(whole(df))
        return cut[-1]

    monkeypatch.setattr(paging, "pin", pinned)
    df = table(spark)
    want = sorted(tuple(r) for r in df.collect())
    assert [tuple(r) for n in (0, 3, 9, 10) for r in page(df, ORDER, 100, n, slice_rows=4).collect()] == want[:100] + want[300:400] + want[900:]
    assert [c.rdd.getNumPartitions() for c in cut] == [7] * 4
