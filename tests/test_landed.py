"""Landed files that can hold nothing newer are not opened again."""

import json
import os
from dataclasses import replace
from datetime import date

import pytest
from helpers import tuples

from vintage.feeds import DEATHS
from vintage.sources import landed

JAN, FEB, MAR = (date(2026, m, 1) for m in (1, 2, 3))


def put(folder, name, *weeks, layout="lines"):
    found = [{"week_ending_date": w and f"{w}T00:00:00", "state": "Ohio", "covid_19_deaths": "1"} for w in weeks]
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text(json.dumps(found) if layout == "pages" else "\n".join(map(json.dumps, found)))
    os.utime(folder / name, (1_700_000_000, 1_700_000_000 + len(list(folder.iterdir()))))


def names(files):
    return [f[0].rsplit("/", 1)[-1] for f in files]


@pytest.mark.parametrize("layout", ["lines", "pages"])
def test_a_second_read_opens_no_old_file(spark, layers, tmp_path, layout):
    landed.create_landed(spark, layers)
    folder = tmp_path / "landing"
    put(folder, "a b+c%.json", JAN, FEB, layout=layout)
    put(folder / "more", "new.json", MAR, layout=layout)
    put(folder, "empty.json", layout=layout)
    empty = ["empty.json"] if layout == "pages" else []  # a file without a byte is not listed
    put(folder, "unknown.json", JAN, None, layout=layout)
    to_read = lambda after: landed.files_to_read(spark, DEATHS, str(folder), layers, after)
    files = to_read(FEB)
    assert sorted(names(files)) == ["a b+c%.json", *empty, "new.json", "unknown.json"] and len(to_read(None)) == 3 + len(empty)
    assert landed.read_files(spark, files, layout).count() == 5
    landed.enter_files(spark, DEATHS, files, layout, layers)
    assert sorted(names(to_read(FEB))) == [*empty, "new.json", "unknown.json"] and len(to_read(None)) == 3 + len(empty)
    assert sorted(names(to_read(JAN))) == ["a b+c%.json", *empty, "new.json", "unknown.json"]
    assert names(to_read(MAR)) == [*empty, "unknown.json"]
    assert len(landed.files_to_read(spark, replace(DEATHS, source="other"), str(folder), layers, MAR)) == 3 + len(empty)
    put(folder, "a b+c%.json", JAN, FEB, FEB, layout=layout)  # written again
    assert sorted(names(to_read(MAR))) == ["a b+c%.json", *empty, "unknown.json"]
    assert landed.read_files(spark, [], layout).count() == 0
    spans = tuples(spark.table(layers.landed), "first_period", "last_period")
    assert spans == sorted([(JAN, FEB), (MAR, MAR), (JAN, None), *[(None, None) for _ in empty]], key=repr)
