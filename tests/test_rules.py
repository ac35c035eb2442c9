import json
from datetime import date

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from vintage.feeds import DEATHS
from vintage.operators import rules

SCHEMA = "run_id string, snapshot_date date, state string, covid_19_deaths bigint, total_deaths bigint"
DAY = date(2026, 9, 1)


def frame(spark, *rows):
    return spark.createDataFrame([("r", DAY, *row) for row in rows], SCHEMA)


def check(df, *checks):
    return [tuple(r) for r in rules.validate(df, checks).orderBy("rule_no").select(
        "evaluated_count", "unexpected_count", "unexpected_percent", "success").collect()]


def test_not_null_counts_all_rows(spark):
    assert check(frame(spark, ("a", 1, 1), (None, 1, 1)), rules.not_be_null("state")) == [(2, 1, 50.0, False)]


def test_between_is_inclusive_and_skips_nulls(spark):
    df = frame(spark, ("a", 0, 1), ("b", 10, 1), ("c", None, 1), ("d", 11, 1), ("e", -1, 1))
    column = "covid_19_deaths"
    assert check(df, rules.be_between(column, 0, 10), rules.be_between(column, 0), rules.be_between(column, max_value=10)) == [
        (4, 2, 50.0, False), (4, 1, 25.0, False), (4, 1, 25.0, False)
    ]


def test_mostly_is_a_minimum_share(spark):
    df = frame(spark, *[("a", -1 if i == 0 else i, 1) for i in range(20)])
    at = rules.be_between("covid_19_deaths", 0, mostly=0.95)
    above = rules.be_between("covid_19_deaths", 0, mostly=0.96)
    assert [row[3] for row in check(df, at, above)] == [True, False]


def test_in_set_skips_nulls(spark):
    df = frame(spark, ("Low", 1, 1), (None, 1, 1), ("low", 1, 1))
    assert check(df, rules.be_in_set("state", ["Low"])) == [(2, 1, 50.0, False)]


@pytest.mark.parametrize(
    "or_equal, ignore, expected",
    [
        (True, "either_value_is_missing", (2, 1)),
        (False, "either_value_is_missing", (2, 2)),
        (True, "both_values_are_missing", (3, 2)),
        (True, "neither", (4, 3)),
    ],
)
def test_pair(spark, or_equal, ignore, expected):
    df = frame(spark, ("a", 5, 5), ("b", 6, 5), ("c", None, 5), ("d", None, None))
    rule = rules.pair_a_greater_than_b("total_deaths", "covid_19_deaths", or_equal, ignore)
    assert check(df, rule)[0][:2] == expected


def test_compound_unique_counts_every_member_and_equal_nulls(spark):
    df = frame(spark, ("a", 1, 1), ("a", 1, 2), ("b", 1, 1), (None, 2, 1), (None, 2, 1), (None, None, 1), (None, None, 1))
    assert check(df, rules.compound_columns_unique("state", "covid_19_deaths"))[0][:2] == (5, 4)


def test_empty_input_passes(spark):
    assert all(row[3] for row in check(frame(spark), *DEATHS.rules))


def test_row_rules_share_one_scan(spark):
    text = plan(rules.validate(frame(spark, ("a", 1, 1)), DEATHS.rules))
    assert text.count("Scan ExistingRDD") == 2  # row rules together, uniqueness


def test_violations_and_sample(spark):
    df = frame(spark, ("a", 1, 1), ("a", 2, 2), (None, 3, 3), (None, 4, 4), ("c", -1, 9))
    unique = rules.compound_columns_unique("run_id", "state")
    assert tuples(rules.violations(df, unique), "covid_19_deaths") == [(1,), (2,), (3,), (4,)]
    assert [r[0] for r in rules.sample_violations(df, unique, ("covid_19_deaths",), 3).select("covid_19_deaths").collect()] == [1, 2, 3]
    assert tuples(rules.violations(df, rules.be_between("covid_19_deaths", 0)), "state") == [("c",)]


@pytest.mark.parametrize("hot_rows", [50, 10**6])
def test_violations_of_a_hot_key(spark, hot_rows):
    rows = [(None if i % 3 == 0 else f"s{i}", i % 3, 1) for i in range(300)] + [("s1", 1, 1), ("s2", 0, 1)]
    unique = rules.compound_columns_unique("state", "covid_19_deaths")
    found = rules.violations(frame(spark, *rows), unique, hot_rows)
    assert found.where("state is null").count() == 100 and tuples(found.where("state is not null"), "state") == [("s1",)] * 2


def test_suite_from_json(spark):
    wanted = [
        ("expect_compound_columns_to_be_unique", {"column_list": ["A", "C"]}, 2),
        ("expect_column_values_to_be_in_set", {"column": "A", "value_set": ["x"]}, 1),
        ("expect_column_values_to_be_between", {"column": "B", "min_value": -1, "max_value": 3}, 2),
        ("expect_column_values_to_not_be_null", {"column": "A"}, 1),
        ("expect_column_pair_values_A_to_be_greater_than_B", {"column_A": "C", "column_B": "B", "or_equal": True}, 1),
    ]
    text = json.dumps({"expectations": [{"expectation_type": name, "kwargs": kwargs} for name, kwargs, _ in wanted]})
    df = spark.createDataFrame([("x", 3, 5), ("y", -2, 9), (None, 3, 1), ("x", 4, 5)], "a string, b bigint, c bigint")
    assert [row[1] for row in check(df, *rules.load_suite(text))] == [n for _, _, n in wanted]


def test_unknown_suite_rule_is_refused():
    with pytest.raises(KeyError):
        rules.load_suite('{"expectations": [{"expectation_type": "expect_magic", "kwargs": {}}]}')


def test_gate(spark):
    results = rules.validate(frame(spark, (None, 1, 1)), DEATHS.rules).collect()
    with pytest.raises(rules.ValidationFailed) as stop:
        rules.require_success(results, "run r")
    assert [r["rule"] for r in stop.value.failures] == ["not_be_null"]
    rules.require_success(rules.validate(frame(spark, ("a", 1, 1)), DEATHS.rules).collect(), "run r")


def test_model_test_counts(spark):
    df = frame(spark, ("x", 1, 1), ("x", 1, 1), ("y", 1, 1), (None, 1, 1), (None, 1, 1), ("Low", 1, 1))
    assert tuples(rules.null_failures(df, ["state", "run_id"])) == [("run_id", "not_null", 0), ("state", "not_null", 2)]
    assert tuples(rules.unique_failures(df, "state")) == [("state", "unique", 1)]
    assert tuples(rules.accepted_failures(df, "state", ("Low",))) == [("state", "accepted_values", 2)]


def test_samples_of_all_single_row_rules_come_from_one_scan(spark):
    df = spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, id) AS a", "cast(id % 50 AS bigint) AS b", "cast(id AS string) AS s")
    checks = (rules.not_be_null("a"), rules.be_between("b", max_value=40), rules.be_in_set("s", ("1",)), rules.be_between("b", min_value=0))
    found = rules.sample_all(df, checks, ("id",), 5)
    for i, rule in enumerate(checks):
        assert tuples(found.where(f"rule_no = {i}"), *df.columns) == tuples(rules.sample_violations(df, rule, ("id",), 5), *df.columns)
    text = plan(found)
    assert text.count("Range (") == 1 and "WindowGroupLimit" in text.split("Exchange")[1]


@pytest.mark.parametrize("hot_rows", [100, 10**6])
def test_uniqueness_survives_colliding_hashes(spark, monkeypatch, hot_rows):
    """With three hash values for everything, the keys themselves decide; nulls equal each other, sides differ."""
    key = "if(id % 3 = 0, -1, if(id % 3 = 1, id, null))"
    df = spark.range(900).selectExpr(f"cast({key} AS string) AS a", "if(id % 2 = 0, null, 'x') AS b").union(
        spark.createDataFrame([("p", None), (None, "p")], "a string, b string")
    )
    expected = (902, 300 + 300)  # -1 and null, each with and without x; the others once
    assert tuple(rules.duplicate_rows_by_hash(df, ("a", "b"), hot_rows).first()) == expected
    monkeypatch.setattr(rules, "_key_hash", lambda keys: F.pmod(F.xxhash64(*keys), F.lit(3)))
    assert tuple(rules.duplicate_rows_by_hash(df, ("a", "b"), hot_rows).first()) == expected


def test_uniqueness_shuffles_hashes_instead_of_keys(spark):
    df = spark.range(1000).selectExpr("repeat(cast(id AS string), 50) AS a", "id AS b")
    hashes = rules.duplicate_keys(df.withColumn("_hash", rules._key_hash(("a", "b"))), ("_hash",))
    exchanged = [line for line in plan(hashes).splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanged) == 1 and "_hash" in exchanged[0] and "a#" not in exchanged[0]
    assert rules.repeated_hashes(df, ("a", "b")).count() == 0
    assert tuple(rules.duplicate_rows_by_hash(df.limit(0), ("a", "b")).first()) == (0, 0)
