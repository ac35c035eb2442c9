"""Every query of the library itself against its SQL oracle on the smallest test tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_queries import problems_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_each_query_has_an_oracle():
    assert set(entry.core_queries()) == set(entry.core_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_stay_when_a_library_of_the_subpackage_is_missing():
    """A fresh interpreter in which importing ``tokenizers`` fails."""
    code = "import sys; sys.modules['tokenizers'] = None; import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.core_queries()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(entry.__file__).parent)
    assert done.stdout.strip().endswith("True"), done.stderr


@pytest.mark.parametrize("name", list(entry.core_queries()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, SF).toArrow()
    assert problems_of(got, db.sql(entry.oracle_sql()[name]).to_arrow_table()) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 161
