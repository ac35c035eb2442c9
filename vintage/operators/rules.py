"""Declarative data rules, evaluated together in one pass over the data."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintage.functions.columns import nan_as_null, percent
from vintage.functions.skew import HOT_ROWS, join_groups

SAMPLE_SIZE = 20


@dataclass(frozen=True)
class Rule:
    """A rule on ``columns``; ``mostly`` is the share of evaluated rows that must satisfy it."""

    name: str
    columns: tuple[str, ...]
    params: dict = field(default_factory=dict, hash=False)
    mostly: float = 1.0

    @property
    def by_key(self) -> bool:
        return self.name == "compound_columns_unique"

    def evaluated(self) -> Column:
        """The rows the rule has a say on."""
        return _EVALUATED[self.name](self)

    def unexpected(self) -> Column:
        """The evaluated rows that break it (rules on single rows only)."""
        return self.evaluated() & ~F.coalesce(_EXPECTED[self.name](self), F.lit(False))


def not_be_null(column: str, mostly: float = 1.0) -> Rule:
    return Rule("not_be_null", (column,), {}, mostly)


def be_between(column: str, min_value=None, max_value=None, mostly: float = 1.0) -> Rule:
    """Inclusive range with either end open; nulls are not evaluated."""
    if min_value is None and max_value is None:
        raise ValueError("be_between needs min_value or max_value")
    return Rule("be_between", (column,), {"min_value": min_value, "max_value": max_value}, mostly)


def be_in_set(column: str, value_set, mostly: float = 1.0) -> Rule:
    return Rule("be_in_set", (column,), {"value_set": tuple(value_set)}, mostly)


def pair_a_greater_than_b(
    column_A: str, column_B: str, or_equal: bool = False, ignore_row_if: str = "both_values_are_missing", mostly: float = 1.0
) -> Rule:
    """A > B (A >= B with ``or_equal``); a missing value on an evaluated row breaks the rule."""
    return Rule(
        "pair_A_greater_than_B",
        (column_A, column_B),
        {"or_equal": bool(or_equal), "ignore_row_if": ignore_row_if},
        mostly,
    )


def pair_a_at_least_b(column_A: str, column_B: str, ignore_row_if: str = "both_values_are_missing", mostly: float = 1.0) -> Rule:
    return pair_a_greater_than_b(column_A, column_B, True, ignore_row_if, mostly)


def compound_columns_unique(*columns: str, ignore_row_if: str = "all_values_are_missing", mostly: float = 1.0) -> Rule:
    """No two rows share all values; nulls equal each other, every member of a group counts."""
    return Rule("compound_columns_unique", columns, {"ignore_row_if": ignore_row_if}, mostly)


def _missing(rule: Rule) -> list[Column]:
    return [F.col(c).isNull() for c in rule.columns]


def _not_ignored(rule: Rule) -> Column:
    missing = _missing(rule)
    every = reduce(Column.__and__, missing)
    some = reduce(Column.__or__, missing)
    return {
        "all_values_are_missing": ~every,
        "both_values_are_missing": ~every,
        "any_value_is_missing": ~some,
        "either_value_is_missing": ~some,
        "never": F.lit(True),
        "neither": F.lit(True),
    }[rule.params["ignore_row_if"]]


def _in_range(rule: Rule) -> Column:
    value, low, high = F.col(rule.columns[0]), rule.params["min_value"], rule.params["max_value"]
    ends = ([value >= low] if low is not None else []) + ([value <= high] if high is not None else [])
    return reduce(Column.__and__, ends)


def _pair_ordered(rule: Rule) -> Column:
    a, b = (F.col(c) for c in rule.columns)
    return a >= b if rule.params["or_equal"] else a > b


_EVALUATED = {
    "not_be_null": lambda rule: F.lit(True),
    "be_between": lambda rule: F.col(rule.columns[0]).isNotNull(),
    "be_in_set": lambda rule: F.col(rule.columns[0]).isNotNull(),
    "pair_A_greater_than_B": _not_ignored,
    "compound_columns_unique": _not_ignored,
}

_EXPECTED = {
    "not_be_null": lambda rule: F.col(rule.columns[0]).isNotNull(),
    "be_between": _in_range,
    "be_in_set": lambda rule: F.col(rule.columns[0]).isin(*rule.params["value_set"]),
    "pair_A_greater_than_B": _pair_ordered,
}

# --- fixed values: rule names of the JSON suite format ---
SUITE_RULES = {
    "expect_column_values_to_not_be_null": lambda kw: not_be_null(kw.pop("column"), **kw),
    "expect_column_values_to_be_between": lambda kw: be_between(kw.pop("column"), **kw),
    "expect_column_values_to_be_in_set": lambda kw: be_in_set(kw.pop("column"), **kw),
    "expect_column_pair_values_A_to_be_greater_than_B": lambda kw: pair_a_greater_than_b(**kw),
    "expect_compound_columns_to_be_unique": lambda kw: compound_columns_unique(*kw.pop("column_list"), **kw),
}


def load_suite(text: str) -> tuple[Rule, ...]:
    """Rules of a suite given as JSON: a list ``expectations`` of expectation_type and kwargs."""
    suite = json.loads(text)
    return tuple(SUITE_RULES[e["expectation_type"]](dict(e["kwargs"])) for e in suite["expectations"])


def duplicate_keys(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys held by more than one row. Only keys are shuffled, counted before the exchange."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _key_hash(keys: tuple[str, ...]) -> Column:
    return F.xxhash64(*keys)


def repeated_hashes(df: DataFrame, keys: tuple[str, ...], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows whose key has a 64-bit hash that another row has too: all that can share their key, and few others.

    Only hashes are shuffled to find them. With mostly unique keys, what is left is next to nothing.
    """
    hashed = df.withColumn("_hash", _key_hash(keys))
    again = duplicate_keys(hashed, ("_hash",)).select("_hash")
    return join_groups(hashed, again, ("_hash",), "left_semi", hot_rows=hot_rows).drop("_hash")


def duplicate_rows(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row: how many rows there are, and how many of them share their key with another."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("evaluated_count"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("unexpected_count"),
    )


def duplicate_rows_by_hash(df: DataFrame, keys: tuple[str, ...], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``duplicate_rows`` in two phases: the keys themselves are compared only where a hash of them repeats.

    Reads the key columns again instead of shuffling them, which pays where keys are wide and mostly unique.
    """
    groups = duplicate_rows(repeated_hashes(df.select(*keys), keys, hot_rows), keys).select("unexpected_count")
    return df.agg(F.count(F.lit(1)).alias("evaluated_count")).crossJoin(groups)


def validate(df: DataFrame, rules: tuple[Rule, ...], by_hash: bool = False) -> DataFrame:
    """One row per rule with its counts and verdict; every rule is evaluated, none stops another.

    All rules on single rows share one aggregation; a uniqueness rule adds one grouped count, of hashes first
    if ``by_hash`` is set (for wide keys). A NaN counts as missing.
    """
    count_duplicates = duplicate_rows_by_hash if by_hash else duplicate_rows
    df = nan_as_null(df)
    measures, results = [], []
    for i, rule in enumerate(rules):
        if rule.by_key:
            counts = count_duplicates(df.where(rule.evaluated()), rule.columns)
            results.append(counts.select(F.lit(i).alias("rule_no"), "evaluated_count", "unexpected_count"))
        else:
            measures += [
                F.count_if(rule.evaluated()).alias(f"e{i}"),
                F.count_if(rule.unexpected()).alias(f"u{i}"),
            ]
    if measures:
        fused = df.agg(*measures)
        entries = [
            F.struct(
                F.lit(i).alias("rule_no"),
                F.col(f"e{i}").alias("evaluated_count"),
                F.col(f"u{i}").alias("unexpected_count"),
            )
            for i, rule in enumerate(rules)
            if not rule.by_key
        ]
        results.append(fused.select(F.inline(F.array(*entries))))
    counted = reduce(DataFrame.unionByName, results)
    names = F.array(*[F.lit(rule.name) for rule in rules])
    columns = F.array(*[F.lit(",".join(rule.columns)) for rule in rules])
    mostly = F.array(*[F.lit(float(rule.mostly)) for rule in rules])
    kept = F.col("evaluated_count") - F.col("unexpected_count")
    satisfied = kept / F.nullif(F.col("evaluated_count").cast("double"), F.lit(0.0))
    return counted.select(
        "rule_no",
        F.get(names, F.col("rule_no")).alias("rule"),
        F.get(columns, F.col("rule_no")).alias("columns"),
        "evaluated_count",
        "unexpected_count",
        percent("unexpected_count", "evaluated_count").alias("unexpected_percent"),
        F.coalesce(satisfied >= F.get(mostly, F.col("rule_no")), F.lit(True)).alias("success"),
    )


def violations(df: DataFrame, rule: Rule, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows that break the rule; a NaN comes back as null."""
    df = nan_as_null(df)
    if not rule.by_key:
        return df.where(rule.unexpected())
    checked = df.where(rule.evaluated())
    repeated = duplicate_keys(checked, rule.columns).select(*rule.columns)
    return join_groups(checked, repeated, rule.columns, "left_semi", null_safe=True, hot_rows=hot_rows)


def judged(df: DataFrame, rules: tuple[Rule, ...], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row once, with ``broken``: the positions of the rules it breaks; a NaN comes back as null.

    Rules on single rows are one expression. A uniqueness rule splits the rows by whether their key is
    repeated, which copes with a key that many rows share.
    """
    single = [F.when(rule.unexpected(), F.lit(i)) for i, rule in enumerate(rules) if not rule.by_key]
    df = nan_as_null(df).withColumn("broken", F.array_compact(F.array(F.lit(None).cast("int"), *single)))
    for i, rule in enumerate(rules):
        if rule.by_key:
            checked = df.where(rule.evaluated())
            repeated = duplicate_keys(checked, rule.columns).select(*rule.columns)
            again, once = (
                join_groups(checked, repeated, rule.columns, how, null_safe=True, hot_rows=hot_rows)
                for how in ("left_semi", "left_anti")
            )
            again = again.withColumn("broken", F.array_sort(F.array_append("broken", F.lit(i))))
            df = again.unionByName(once).unionByName(df.where(~rule.evaluated()))
    return df


def sample_violations(df: DataFrame, rule: Rule, order: tuple[str, ...], n: int = SAMPLE_SIZE) -> DataFrame:
    """The first ``n`` violations in ``order``."""
    return violations(df, rule).orderBy(*order).limit(n)


def sample_all(df: DataFrame, rules: tuple[Rule, ...], order: tuple[str, ...], n: int = SAMPLE_SIZE) -> DataFrame:
    """The first ``n`` violations in ``order`` of every rule, with the rule's position in ``rule_no``.

    Rules on single rows share one scan. It keeps the ``n`` smallest rows of each rule in a task before
    anything is shuffled.
    """
    single = [F.when(rule.unexpected(), F.lit(i)) for i, rule in enumerate(rules) if not rule.by_key]
    parts = []
    if single:
        broken = nan_as_null(df).withColumn("rule_no", F.explode(F.array_compact(F.array(*single))))
        in_order = Window.partitionBy("rule_no").orderBy(*order)
        ranked = broken.withColumn("_rank", F.row_number().over(in_order)).where(F.col("_rank") <= n)
        parts.append(ranked.select("rule_no", *df.columns))
    for i, rule in enumerate(rules):
        if rule.by_key:
            parts.append(sample_violations(df, rule, order, n).select(F.lit(i).alias("rule_no"), *df.columns))
    return reduce(DataFrame.unionByName, parts)


class ValidationFailed(ValueError):
    """Raised by the gate; ``failures`` holds the result rows of the broken rules."""

    def __init__(self, message: str, failures: list):
        super().__init__(message)
        self.failures = failures


def verdict(results: DataFrame) -> DataFrame:
    """One row: overall success and the number of broken rules."""
    return results.agg(
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("success"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
    )


def require_success(results: list, label: str) -> None:
    """Stop everything that follows when a rule is broken. ``results`` are collected rule rows."""
    failures = [row for row in results if not row["success"]]
    if failures:
        broken = ", ".join(f"{row['rule']}({row['columns']}): {row['unexpected_count']}" for row in failures)
        raise ValidationFailed(f"{label}: {len(failures)} rule(s) failed: {broken}", failures)


# --- tests on finished models: one row per test with its failures, 0 passes ---


def _failures(df: DataFrame, column: str, test: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(column).alias("column_name"), F.lit(test).alias("test"), "failures"
    )


def null_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of nulls of each column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("test"), F.col(c).alias("failures"))
        for c in columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Number of values held more than once; nulls are ignored."""
    return _failures(duplicate_keys(df.where(F.col(column).isNotNull()), (column,)), column, "unique")


def accepted_failures(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    """Number of distinct values outside the accepted ones; nulls pass."""
    return _failures(df.where(~F.col(column).isin(*values)).select(column).distinct(), column, "accepted_values")
