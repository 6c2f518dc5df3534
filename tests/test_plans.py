"""Plans that must stay as they are to hold at scale."""

import collections
import re

import pytest

from ledgersift.operators.asof import asof_join
from ledgersift.operators.dedupe import dedupe_by_key
from ledgersift.session import scratch_dir
from ledgersift.workload.queries import QUERIES
from ledgersift.workload.tables import tx_raw


@pytest.fixture(scope="module", autouse=True)
def long_plans(spark):
    spark.conf.set("spark.sql.maxPlanStringLength", "2000000")


def children(node):
    """What stands below a node of an executed plan, subqueries included."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return [node.executedPlan()]
    if kind.endswith("QueryStageExec"):
        return [node.plan()]
    if kind == "ReusedExchangeExec":
        return []  # its plan stands where it was first made
    below = [node.children(), node.subqueries()]
    return [seq.apply(i) for seq in below for i in range(seq.size())]


def nodes(df):
    """(kind, description) of all nodes of the plan as it was run."""
    return [(n.getClass().getSimpleName().removesuffix("Exec"), n.simpleString(10_000)) for n in plan_nodes(df)]


def kinds(df):
    return collections.Counter(kind for kind, _ in nodes(df))


PAIRS_OR_PYTHON = re.compile("CartesianProduct|NestedLoopJoin|Python|Pandas|Arrow")
NO_CROSS = [n for n in QUERIES if n.startswith(("clean_", "prof_", "feat_", "check_"))]


def misplaced(df):
    found = plan_nodes(df)
    names = [n.getClass().getSimpleName() for n in found]
    # A window without partition would bring all rows into one task.
    alone = [n.simpleString(200) for n, k in zip(found, names) if k == "WindowExec" and n.partitionSpec().size() == 0]
    return [k for k in names if PAIRS_OR_PYTHON.search(k)] + alone


@pytest.mark.parametrize("name", NO_CROSS)
def test_no_pairs_and_no_python(spark, sf, name):
    assert misplaced(QUERIES[name](spark, sf["sf0.001"])) == []


def test_a_pair_under_a_subquery_is_seen(spark):
    crossed = spark.range(3).crossJoin(spark.range(4).toDF("b")).agg({"b": "max"}).scalar()
    assert any("Join" in k or "Cartesian" in k for k in misplaced(spark.range(5).withColumn("most", crossed)))
    assert misplaced(spark.range(5).selectExpr("row_number() OVER (ORDER BY id) AS n"))


SCANS = {"clean_pipeline_a": 2, "clean_pipeline_b": 2, "clean_report": 2, "prof_all_checks": 5, "feat_materialize": 1}


@pytest.mark.parametrize("name", SCANS)
def test_scans(spark, sf, name):
    assert kinds(QUERIES[name](spark, sf["sf0.001"]))["FileSourceScan"] <= SCANS[name]


@pytest.mark.parametrize("name", ["clean_pipeline_a", "clean_pipeline_b", "clean_report", "feat_historical_multi"])
def test_the_statistics_share_the_shuffle(spark, sf, name):
    assert kinds(QUERIES[name](spark, sf["sf0.001"]))["ReusedExchange"] >= 1


def test_two_views_on_one_source_take_one_pass(spark, sf):
    # The mean of the score reads the joined rows a second time.
    assert kinds(QUERIES["feat_historical_multi"](spark, sf["sf0.001"]))["Window"] <= 2


def jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    run()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_counting_does_not_grow_with_the_sources(spark, sf):
    """Building the plan with two sources counts as often as with one."""
    one = jobs(spark, "one", lambda: QUERIES["feat_historical_ttl"](spark, sf["sf0.001"]))
    two = jobs(spark, "two", lambda: QUERIES["feat_historical_two_sources"](spark, sf["sf0.001"]))
    assert 0 < two <= one + 2  # reading another table starts up to two


def test_rows_without_a_key_are_not_shuffled(spark):
    rows = spark.range(1000).selectExpr("CASE WHEN id < 10 THEN id END AS k", "timestamp_ntz'2024-01-02 00:00:00' AS t", "id AS v")
    known = spark.sql("SELECT 1L AS k, timestamp_ntz'2024-01-01 00:00:00' AS t, 'x' AS f")
    joined = asof_join(rows, known, ["k"], "t", "t", ["f"])
    assert joined.count() == 1000
    written = [
        node for node in plan_nodes(joined) if node.getClass().getSimpleName() == "ShuffleExchangeExec"
    ]
    assert written and all(n.metrics().apply("shuffleRecordsWritten").value() <= 11 for n in written)


def plan_nodes(df):
    df.collect()
    todo, out = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        out.append(todo.pop())
        todo += children(out[-1])
    return out


def plan(df):
    return "\n".join(text for _, text in nodes(df))


def test_key_dedupe_combines_before_the_shuffle(spark, sf):
    found = nodes(dedupe_by_key(tx_raw(spark, sf["sf0.001"]), ["transaction_id"], ["tx_datetime"]))
    at = [k for k, (kind, _) in enumerate(found) if kind == "ShuffleExchange"]
    assert len(at) == 1 and any("partial_min" in text for _, text in found[at[0] + 1 :])


def test_filters_and_columns_reach_the_files(spark, sf):
    path = scratch_dir(spark, "clean")
    QUERIES["clean_pipeline_a"](spark, sf["sf0.001"]).write.parquet(path)
    text = plan(spark.read.parquet(path).filter("tx_amount > 50").select("customer_id"))
    assert "GreaterThan(tx_amount,50.0)" in text
    assert "ReadSchema: struct<customer_id:bigint,tx_amount:double>" in text


def test_selected_files_are_the_only_ones_read(spark, sf):
    files = QUERIES["src_select_latest"](spark, sf["sf0.001"]).inputFiles()
    assert files and {re.search(r"day=([0-9-]+)", f).group(1) for f in files} == {"2024-01-30"}


def test_scratch_is_shared_or_local(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
