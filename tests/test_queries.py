from __future__ import annotations

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import compare, duck  # noqa: E402

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_its_sql(spark, tables, name):
    good, note = compare(spark, tables, FOLDER, name)
    assert good, note


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
