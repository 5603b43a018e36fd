import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from curbline.bindings.catalog import QUERIES
from curbline.bindings.oracles import ORACLES
from oracle_compare import database, difference

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_the_sql_needs_no_session():
    code = "import __spark_entry__ as e; print(len(e.oracle_sql()) <= len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "True", done.stderr


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SMALL)
    assert difference(df, con, entry_points.oracle_sql()[name]) is None
