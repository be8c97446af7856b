"""Plans: filters reach the scan, nothing crosses, no row-at-a-time Python."""

import pytest

from changeledger.plans import QUERIES
from tests.conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))  # these end in a stored table
def test_no_cross_join_or_row_udf(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not any(bad in text for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"))


def test_cursor_reaches_the_scan(spark):
    text = plan(QUERIES["watermark_scan"](spark, SF))
    assert "TakeOrderedAndProject" in text and "GreaterThanOrEqual(ts," in text and "IsNotNull(ts)" in text
    assert "props" not in text.split("ReadSchema")[1]


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["keyset_composite"](spark, SF))
    assert "GreaterThanOrEqual(l_shipdate" in text and "l_tax" not in text.split("ReadSchema")[1]


def test_retention_cuts_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["recent_errors"](spark, SF))


def test_retention_sorts_no_whole_group(spark):
    """The last kept rows are found and stored before; what is left is one join with them."""
    text = plan(QUERIES["keep_newest"](spark, SF))
    assert "Window" not in text and "Join" in text


def test_sequences_shuffle_wide_rows_once(spark):
    """A chunk's rows meet their numbers by row number; its images, which the batches do not want, are not read."""
    text = plan(QUERIES["minimum_slice"](spark, SF))
    assert text.count("Exchange hashpartitioning(__row") <= 2 and text.count("Exchange hashpartitioning") <= 6
    assert "after:string" not in text
