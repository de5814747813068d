"""Physical-plan checks: the window reaches the scan, config-sized sides are
broadcast, no Python UDF anywhere."""

import contextlib
import io

import pytest

from dealspark.plans.pipeline import Stages
from dealspark.plans.registry import registry
from dealspark.sources.extracts import fixture_view_inputs, store_inputs, table_inputs
from dealspark.sources.fixtures import MAIN

from .conftest import SF_SMALL


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored_stages(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    return lambda cfg=MAIN: Stages(spark, table_inputs(spark, *paths), cfg) if (paths := _store(spark, root)) else None


_PATHS = {}


def _store(spark, root):
    if root not in _PATHS:
        _PATHS[root] = store_inputs(fixture_view_inputs(spark, SF_SMALL), root)
    return _PATHS[root]


def test_period_window_is_a_partition_filter(stored_stages):
    text = plan_text(stored_stages().extracts.transactions)
    blocks = [b.strip() for b in text.split("\n\n")]
    scans = [b for b in blocks if b.startswith("(") and "Scan parquet" in b.splitlines()[0]]
    assert scans and all("PartitionFilters: [isnotnull(ending_period" in b for b in scans)
    assert any(">= 2019-01-01" in b and "<= 2020-12-31" in b for b in scans)


def test_scan_reads_only_needed_columns(spark):
    text = plan_text(registry()["aep_totals"](spark, SF_SMALL))
    read = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert read and all("item_name" not in line and "final_close_price" not in line for line in read)


def test_crosswalk_semi_join_is_broadcast(spark):
    text = plan_text(registry()["market_scope"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


@pytest.mark.parametrize("name", ["deal_data", "cohort_mix", "fee_isolated_ledger"])
def test_no_python_udf_and_no_cartesian(spark, name):
    text = plan_text(registry()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_full_outer_is_not_used_for_the_aep_merge(spark):
    text = plan_text(registry()["deal_aep_outer"](spark, SF_SMALL))
    assert "FullOuter" not in text and "LeftAnti" in text


def test_checked_small_sides_are_broadcast_and_the_ledger_is_filtered_where_read(spark):
    text = plan_text(registry()["deal_aep_outer"](spark, SF_SMALL))
    assert "BroadcastHashJoin LeftOuter BuildRight" in text
    assert "BroadcastHashJoin LeftSemi BuildRight" in text
    text = plan_text(registry()["deal_data"](spark, SF_SMALL))
    assert text.count("BroadcastHashJoin LeftOuter BuildRight") >= 2  # AEP totals and roster


def ledger_scans(df) -> int:
    text = plan_text(df)
    return text.count("Location: InMemoryFileIndex") and sum(
        1 for b in text.split("\n\n") if "Scan parquet" in b and "ledger_lines" in b)


def test_merges_read_the_ledger_a_few_times_only(stored_stages):
    st = stored_stages()
    assert 1 <= ledger_scans(st.deal_data) <= 3
    assert 1 <= ledger_scans(st.fee_isolated_ledger) <= 4
    assert ledger_scans(st.extracts.transactions) == 1


def jobs_of(spark, build) -> int:
    spark.sparkContext.setJobGroup("count-jobs", "count-jobs")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("count-jobs"))
    build()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup("count-jobs")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n


def test_extracts_start_no_job_and_a_merge_stores_its_side_once(spark, stored_stages):
    q = registry()
    # Reading a Parquet folder's schema is a job of its own, counted by the plain reads.
    files = jobs_of(spark, lambda: [spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in
                                    ("orders", "customer", "nation", "region", "lineitem", "supplier")])
    for name in ("principal_roster", "deal_ledger", "aep_totals"):
        assert jobs_of(spark, lambda: q[name](spark, SF_SMALL)) <= files
    st = stored_stages()
    first = jobs_of(spark, lambda: st.deal_data)
    assert first > 0 and jobs_of(spark, lambda: (st.deal_data, st.principal_data, st.reclassed)) == 0


def test_shares_use_no_window_over_a_market(spark):
    for name in ("cohort_share", "cohort_share_positional", "cohort_mix"):
        text = plan_text(registry()[name](spark, SF_SMALL))
        for line in text.splitlines():
            if line.strip().startswith("Arguments: ") and "windowspecdefinition" in line:
                assert "windowspecdefinition(market_region" not in line or "position" in line, (name, line)


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _hot_rows(spark):
    from pyspark.sql import functions as F
    # 80% of the deal rows on one team, one key holding most of the data
    return spark.range(200000).select(
        F.when(F.col("id") % 10 < 8, F.lit("HOT")).otherwise(F.concat(F.lit("T"), (F.col("id") % 50).cast("string")))
        .alias("team_id"),
        F.col("id").cast("string").alias("deal_id"),
        (F.col("id") * 7).alias("net_company_dollar"),
    )


def test_hot_team_is_split_in_the_shuffled_roster_join(skew_session):
    from dealspark.operators.deals import attach_roster
    spark = skew_session
    slim = spark.createDataFrame([("HOT", "A", 1), ("HOT", "B", 2), ("T3", "C", 3)],
                                 "roster_team_id string, account_team_name string, number_of_agents int")
    out = attach_roster(_hot_rows(spark), slim, broadcast_roster=False)
    assert len(out.collect()) == 160000 * 2 + 40000
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_in_the_shuffled_outer_merge(skew_session):
    from dealspark.operators.merge import outer_merge
    spark = skew_session
    side = spark.createDataFrame([("HOT", 5), ("T3", 6), ("NEW", 7)], "team_id string, aep_adjusted long")
    out = outer_merge(_hot_rows(spark), side, null_safe=("team_id",), broadcast_side=False)
    # every large row, plus the side rows no large row meets ('T3' never occurs on the large side, nor 'NEW')
    assert len(out.collect()) == 200000 + 2
    assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()


def test_null_teams_are_split_too(skew_session):
    """A NULL key never matches, but as many rows as a hot key may have it."""
    from pyspark.sql import functions as F

    from dealspark.operators.deals import attach_roster
    spark = skew_session
    rows = _hot_rows(spark).withColumn("team_id", F.when(F.col("team_id") != "HOT", F.col("team_id")))
    slim = spark.createDataFrame([("T3", "C", 3)], "roster_team_id string, account_team_name string, number_of_agents int")
    out = attach_roster(rows, slim, broadcast_roster=False)
    assert len(out.collect()) == 200000


def rows_read(df):
    df.collect()
    found, queue = 0, [df._jdf.queryExecution().executedPlan()]
    while queue:
        node = queue.pop()
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return found


def test_sorted_files_let_the_side_scans_skip_lines(spark, tmp_path):
    """One period of 300,000 lines: pages without the AEP account or a fee item are not read."""
    from pyspark.sql import functions as F

    from dealspark.sources.extracts import Extracts, Inputs, checked_ledger, STORED_ORDER
    small = fixture_view_inputs(spark, SF_SMALL)
    line = small.ledger(None).limit(3000).drop("ending_period", "account_number", "item_id", "item_type_name")
    many = line.crossJoin(spark.range(100).select((F.col("id") * 7919 % 100).alias("n"))).select(
        "*", F.to_date(F.lit("2020-03-31")).alias("ending_period"),
        F.when(F.col("n") % 10 == 0, "502001").otherwise(F.concat(F.lit("4000"), F.col("n"))).alias("account_number"),
        F.when(F.col("n") == 7, "799").otherwise("1").alias("item_id"), F.when(F.col("n") % 20 == 0, "AEP").otherwise("STD").alias("item_type_name")).drop("n")
    read = {}
    for name, df in (("as they come", many.repartition(1)), ("stored", None)):
        if df is None:
            path = store_inputs(Inputs(ledger=lambda w: many.coalesce(1), roster=small.roster), str(tmp_path))[0]
        else:
            path = f"{tmp_path}/plain"
            df.write.partitionBy("ending_period").parquet(path)
        base = checked_ledger(spark.read.parquet(path))
        got = Extracts(Inputs(ledger=lambda w: base.where(F.col("ending_period").between(*w)), roster=small.roster), MAIN)
        read[name] = [(rows_read(x), x.count()) for x in (got.aep, got.fees)]
    plain, stored = read["as they come"], read["stored"]
    assert [n for _, n in plain] == [n for _, n in stored] == [15_000, 3_000]
    assert all(a == 300_000 for a, _ in plain) and stored[0][0] < 100_000 and stored[1][0] < 100_000
    assert STORED_ORDER[0] == "ending_period"
