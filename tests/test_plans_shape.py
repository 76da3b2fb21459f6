"""What physical plans look like where it matters. test_registered checks every plan for what it may not contain."""

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_samples_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["replay_diff"](spark, SF))


def test_scan_reads_only_what_a_query_uses(spark):
    text = plan(QUERIES["tallies"](spark, SF))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "o_orderkey" in line)
    assert "o_orderdate" not in scan.split("Batched")[0]


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["rejected_fold"](spark, SF))
    assert "EqualTo(event_type,error)" in text
