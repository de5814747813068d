"""Bucketed tables: the ledger side of J1 and J5 is not shuffled, hot keys spread."""

import pytest
from pyspark.sql import functions as F

from dealspark.operators import colocated as C
from dealspark.operators.merge import outer_merge
from dealspark.plans.colocated import BucketedStages
from dealspark.sources.extracts import fixture_view_inputs
from dealspark.sources.fixtures import MAIN

from .conftest import SF_SMALL


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    """The plan before adaptive execution changes it."""
    plan = df._jdf.queryExecution().executedPlan()
    return plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def joins(df):
    return [n for n in nodes(plan_of(df)) if "Join" in n.nodeName()]


def bucketed_scans(plan):
    return [n for n in nodes(plan) if n.nodeName().startswith("Scan") and n.bucketedScan()]


def test_the_ledger_side_of_both_joins_has_no_exchange(no_broadcast):
    st = BucketedStages(no_broadcast, fixture_view_inputs(no_broadcast, SF_SMALL), MAIN)
    for df, exact in ((st.deal_aep_outer, 2), (st.deal_data, 1)):
        seen = 0
        for join in joins(df):
            for side in (join.children().apply(0), join.children().apply(1)):
                if bucketed_scans(side):
                    assert not [n for n in nodes(side) if n.nodeName().startswith("Exchange")], side.toString()
                    seen += 1
        assert seen == exact
    per_team = st.principal_year
    (join,) = [j for j in joins(per_team) if bucketed_scans(j)]
    assert not [n for n in nodes(join.children().apply(0)) if n.nodeName().startswith("Exchange")]


def test_a_hot_key_spreads_over_buckets(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "HOT").alias("team_id"), F.col("id").cast("string").alias("deal_id"))
    rows = rows.withColumn(C.KEY, C.salted_key(("team_id",), ("deal_id",), 8))
    parts = C.bucketed(rows, 32, "hot").groupBy(F.input_file_name()).count()
    assert parts.agg(F.max("count")).first()[0] < 20_000 / 4


def test_digests_tell_nulls_and_borders_apart(spark):
    rows = spark.createDataFrame([(None, None), ("", None), (None, ""), ("a", "b"), ("ab", ""), ("", "ab"), ("null", None), ('"', "a")], "x string, y string")
    assert rows.select(C.digest(("x", "y")).alias("d")).distinct().count() == rows.count()


@pytest.mark.parametrize("salts", [1, 5])
def test_the_merge_equals_the_one_without_buckets(spark, salts):
    keys = ("deal_id", "team_id")
    large = spark.range(600).select(F.when(F.col("id") % 7 > 0, (F.col("id") % 90).cast("string")).alias("deal_id"),
                                    F.when(F.col("id") % 4 > 0, F.concat(F.lit("T"), F.col("id") % 5)).alias("team_id"), F.col("id").alias("v"))
    side = large.where("v % 3 = 0").select(*keys).distinct().withColumn("s", F.lit(2))
    side = side.unionByName(spark.createDataFrame([("x", None, 1), (None, "y", 3)], "deal_id string, team_id string, s int"))
    clustered = C.bucketed(large.withColumn(C.KEY, C.salted_key(keys, ("v",), salts)), 4, "merge")
    got, want = C.outer_merge(clustered, side, keys, salts).drop(C.KEY), outer_merge(large, side, null_safe=keys)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
