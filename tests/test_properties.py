"""Property tests: the outer merge equals a null-safe full outer join; the
ledger composites equal the sums of their account columns."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dealspark.functions.chart import GCI_ACCOUNTS, account_column
from dealspark.operators.merge import outer_merge
from dealspark.plans.registry import registry

from .conftest import SF_SMALL

keys = st.one_of(st.none(), st.integers(0, 3))
rows = st.lists(st.tuples(keys, st.sampled_from([None, "a", "b"]), st.integers(0, 99)), max_size=8)


def _key(rs):
    return sorted(tuple(repr(v) for v in r) for r in rs)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(big_rows=rows, side_rows=rows, broadcast=st.booleans())
def test_outer_merge_is_full_outer(spark, big_rows, side_rows, broadcast):
    big = spark.createDataFrame(big_rows, "k1 int, k2 string, v int")
    side = spark.createDataFrame(side_rows, "k1 int, k2 string, w int")
    got = _key(outer_merge(big, side, null_safe=("k1",), strict=("k2",), broadcast_side=broadcast).collect())
    cond = big.k1.eqNullSafe(side.k1) & (big.k2 == side.k2)
    want = _key(big.join(side, cond, "full_outer").select(
        F.when(big.v.isNotNull(), big.k1).otherwise(side.k1),
        F.when(big.v.isNotNull(), big.k2).otherwise(side.k2), big.v, side.w).collect())
    assert got == want


def test_gci_is_sum_of_its_accounts_and_grain_unique(spark):
    df = registry()["deal_ledger"](spark, SF_SMALL)
    total = sum((F.coalesce(F.col(account_column(a)), F.lit(0.0)) for a in GCI_ACCOUNTS), F.lit(0.0))
    bad = df.filter(F.abs(F.coalesce(F.col("total_gci"), F.lit(0.0)) - total) > 1e-6).count()
    assert bad == 0
    grain = ["market_region", "team_id", "deal_id", "side_represented", "listing_type", "location_name",
             "department_name", "ending_period", "close_date", "final_close_price", "vendor_agent_id",
             "company_agent_id"]
    assert df.count() == df.dropDuplicates(grain).count()


def test_market_total_shares_sum_to_one(spark):
    df = registry()["cohort_share"](spark, SF_SMALL).filter(F.col("cohort") == "Total Principal Cohorts")
    sums = df.groupBy("market_region").agg(F.sum("pct_gci_less_referral_2019").alias("s"),
                                           F.max("market_gci_less_referral_2019").alias("m")).collect()
    for r in sums:
        if r["m"]:
            assert abs(r["s"] - 1.0) < 1e-9


def test_shuffle_plans_equal_broadcast_plans(spark):
    """Above the broadcast bound the job switches to shuffle joins; the results
    must not change."""
    import dataclasses

    from dealspark.sources.fixtures import LATE
    from dealspark.functions.columns import money_to_double
    from dealspark.plans.pipeline import Stages
    from dealspark.sources.extracts import fixture_view_inputs

    inputs = fixture_view_inputs(spark, SF_SMALL)
    for cfg in (LATE,):
        big = dataclasses.replace(cfg, broadcast_max_bytes=0)
        for stage in ("deal_data", "principal_data", "fee_isolated_ledger"):
            a = money_to_double(getattr(Stages(spark, inputs, cfg), stage))
            b = money_to_double(getattr(Stages(spark, inputs, big), stage))
            assert _key(a.collect()) == _key(b.collect()), stage
        plan = Stages(spark, inputs, big).deal_aep_outer._jdf.queryExecution().executedPlan().toString()
        assert "LeftSemi" not in plan and "LeftAnti" in plan


def test_each_cohort_is_within_the_total_and_deals_keep_every_row(spark):
    q = registry()
    members = q["cohort_members"](spark, SF_SMALL)
    keys = ["market_region", "market", "location_name", "team_id", "account_team_name", "listing_type",
            "original_start_date"]
    total = members.filter(F.col("cohort") == "Total Principal Cohorts").select(*keys)
    outside = members.filter(F.col("cohort") != "Total Principal Cohorts").select(*keys).exceptAll(total)
    assert outside.count() == 0
    splits = q["deal_splits"](spark, SF_SMALL)
    data = q["deal_data"](spark, SF_SMALL)
    # every deal row survives the roster join (at least once)
    assert data.select("deal_id", "team_id", "ending_period", "side_represented").distinct().count() == \
        splits.select("deal_id", "team_id", "ending_period", "side_represented").distinct().count()


def test_view_inputs_equal_stored_inputs(spark, tmp_out):
    """The lazy fixture views (window pushed to the orders scan as a date
    range) give the same extracts as the stored, partitioned tables."""
    from dealspark.functions.columns import money_to_double
    from dealspark.sources.extracts import Extracts, fixture_view_inputs, store_inputs, table_inputs
    from dealspark.sources.fixtures import LATE, MAIN

    views = fixture_view_inputs(spark, SF_SMALL)
    stored = table_inputs(spark, *store_inputs(views, tmp_out))
    for cfg in (MAIN, LATE):
        for name in ("transactions", "aep", "fees", "roster"):
            a = money_to_double(getattr(Extracts(views, cfg), name))
            b = money_to_double(getattr(Extracts(stored, cfg), name))
            assert _key(a.collect()) == _key(b.collect()), (cfg.begin, name)


def test_no_row_of_an_early_year_is_lost_in_the_pivot(spark):
    q = registry()
    years = {r["ending_year"] for r in q["deal_data_late"](spark, SF_SMALL).select("ending_year").distinct().collect()}
    assert "2018" in years
    pivot = q["principal_pivot_late"](spark, SF_SMALL)
    assert {f"deal_count_{y}" for y in years} <= set(pivot.columns)
    empty = pivot.where(" AND ".join(f"deal_count_{y} IS NULL" for y in (2018, 2019, 2020)))
    assert pivot.count() > 0 and empty.count() == 0


def test_fixture_teams_keep_a_fixed_number_of_principals(spark):
    from dealspark.sources.extracts import fixture_view_inputs
    for sf in ("0.001", "0.01", "0.1"):
        r = fixture_view_inputs(spark, f"/root/testdata/sf{sf}").roster.where("team_id IS NOT NULL").groupBy("team_id").count()
        assert r.agg(F.max("count")).first()[0] <= 2
