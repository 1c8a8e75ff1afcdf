"""Every query against its SQL counterpart."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tallybrook.plans.bindings import QUERIES  # noqa: E402
from tallybrook.plans.oracles import ORACLES  # noqa: E402
from tools.compare import canonical, oracle_connection  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) & set(entry.oracle_sql())))
def test_query(name, spark, duck):
    ours = entry.queries()[name](spark, SF_DIR).toPandas()
    theirs = duck.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    a, b = canonical(ours), canonical(theirs)
    assert len(a) == len(b)
    assert a.equals(b)


def test_each_query_of_the_library_has_an_oracle_and_the_reverse():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "cnt"]


@pytest.mark.parametrize("name", ["wc_top5", "wc_whitespace", "multiplier_dist", "join_agg_sort"])
def test_sorted_queries_keep_their_order(name, spark, duck):
    ours = [tuple(r) for r in entry.queries()[name](spark, SF_DIR).collect()]
    theirs = duck.execute(entry.oracle_sql()[name]).fetchall()
    assert [r[0] for r in ours] == [r[0] for r in theirs]
