"""Operator unit tests on literal frames, each with its NULL case."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F


def rows_key(rows):
    return sorted((tuple(repr(v) for v in r) for r in rows))
from pyspark.sql import types as T

from dealspark.config import CohortBand, ReportConfig, from_mapping
from dealspark.functions.columns import canonical_id, normalized_region
from dealspark.operators import aep, cohorts, deals, fees, ledger, principals, roster
from dealspark.operators.merge import outer_merge
from dealspark.session import materialize
from dealspark.sources.extracts import ROSTER_COLUMNS, Inputs, checked_ledger, principal_roster, renamed
from dealspark.sources.fixtures import MAIN

D = dt.date


def test_normalized_region_split_rule(spark):
    df = spark.createDataFrame(
        [("AMERICA", "NATION_1, AMERICA"), ("AMERICA", None), ("AMERICA", ""), ("AMERICA", "NOCOMMA"),
         ("ASIA", "NATION_2, ASIA"), (None, "X, Y")],
        "r string, l string",
    )
    out = [r[0] for r in df.select(normalized_region(F.col("r"), F.col("l"), "AMERICA")).collect()]
    assert out == ["NATION_1", None, "", "NOCOMMA", "ASIA", None]


def test_canonical_id_text_and_integer(spark):
    df = spark.createDataFrame([("123.0", 7), ("45", 8), (None, None)], "s string, n long")
    rows = df.select(canonical_id(F.col("s"), T.StringType()), canonical_id(F.col("n"), T.LongType())).collect()
    assert [tuple(r) for r in rows] == [("123", "7"), ("45", "8"), (None, None)]


LINE_SCHEMA = (
    "deal_id long, deal_line_id long, team_id string, market_region string, location_name string, "
    "department_name string, side_represented string, listing_type string, close_date date, ending_period date, "
    "final_close_price decimal(18,2), vendor_agent_id string, company_agent_id string, account_number string, "
    "item_type_name string, item_id string, item_name string, amount decimal(18,2)"
)


def line(deal, account, amount, team="T1", period=D(2019, 1, 31), line_id=None, **kw):
    row = dict(deal_id=deal, deal_line_id=line_id, team_id=team, market_region="ASIA", location_name="N, ASIA",
               department_name="D", side_represented="R", listing_type="L", close_date=period, ending_period=period,
               final_close_price=Decimal("100.00"), vendor_agent_id="V", company_agent_id="C",
               account_number=account, item_type_name="STD", item_id="1", item_name="other",
               amount=None if amount is None else Decimal(amount))
    row.update(kw)
    return row


def lines_df(spark, rows):
    names = [f.split()[0] for f in LINE_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], LINE_SCHEMA)


def test_deal_ledger_absent_account_is_zero_and_all_null_is_null(spark):
    df = lines_df(spark, [
        line(1, "400001", "100.00"), line(1, "502001", "-30.00"), line(1, "430011", None),
        line(2, "400002", "10.00"), line(3, "430011", None),
    ])
    out = {r["deal_id"]: r for r in ledger.deal_ledger(df, MAIN).collect()}
    d1, d2, d3 = out["1"], out["2"], out["3"]
    assert d1["acct_400001"] == 10000 and d1["total_gci"] == 10000
    assert d1["acct_400002"] == 0          # absent account: 0
    assert d1["acct_430011"] == 0          # NULL amount next to other lines: 0
    assert d3["acct_430011"] is None       # every line matched with a NULL amount: NULL
    assert d3["total_gci"] == 0
    assert d1["commission_expense"] == -3000
    assert d1["gci_less_referral"] == 10000 and d1["company_dollar"] == 7000
    assert d2["acct_430011"] == 0


def test_deal_ledger_grain_and_deal_key_fallback(spark):
    df = lines_df(spark, [line(None, "400001", "1.00", line_id=9), line(9, "400001", "2.00"),
                          line(None, "400001", "4.00")])
    out = {r["deal_id"]: r["total_gci"] for r in ledger.deal_ledger(df, MAIN).collect()}
    assert out == {"9": 300, None: 400}


@pytest.mark.parametrize("broadcast", [False, True])
def test_outer_merge_equals_null_safe_full_outer(spark, broadcast):
    big = spark.createDataFrame([(1, "a", 10), (None, "b", 20), (None, None, 30), (2, "c", 40), (2, "c", 41)],
                                "k1 int, k2 string, v int")
    side = spark.createDataFrame([(None, None, 1), (2, "c", 2), (3, "d", 3), (None, "z", 4)],
                                 "k1 int, k2 string, w int")
    got = rows_key(outer_merge(big, side, null_safe=("k1", "k2"), broadcast_side=broadcast).collect())
    cond = big.k1.eqNullSafe(side.k1) & big.k2.eqNullSafe(side.k2)
    want = rows_key(big.join(side, cond, "full_outer").select(
        F.coalesce(big.k1, side.k1), F.coalesce(big.k2, side.k2), big.v, side.w).collect())
    assert got == want


@pytest.mark.parametrize("broadcast", [False, True])
def test_outer_merge_strict_key_never_matches_null(spark, broadcast):
    big = spark.createDataFrame([(1, None, 10)], "k int, dept string, v int")
    side = spark.createDataFrame([(1, None, 5)], "k int, dept string, w int")
    got = rows_key(outer_merge(big, side, null_safe=("k",), strict=("dept",), broadcast_side=broadcast).collect())
    assert got == rows_key([(1, None, 10, None), (1, None, None, 5)])


def test_aep_reclass_and_aep_only_rows(spark):
    deals_df = ledger.deal_ledger(lines_df(spark, [line(1, "400001", "100.00"), line(1, "502001", "-50.00")]), MAIN)
    aep_lines = spark.createDataFrame(
        [("1", "T1", D(2019, 1, 31), -2000, "ASIA", "R", "L"), ("7", "T1", D(2019, 1, 31), -500, "ASIA", "R", "L")],
        "deal_id string, team_id string, ending_period date, amount long, market_region string, "
        "side_represented string, listing_type string")
    merged = aep.reclass_commission(aep.deal_aep_outer(deals_df, aep.aep_totals(aep_lines)))
    rows = {r["deal_id"]: r for r in deals.with_splits(merged).collect()}
    assert rows["1"]["commission_expense"] == -5000 - (-2000)
    assert rows["1"]["aep_total"] == 0 + (-2000)
    # AEP-only row: no ledger match, so its AEP total is 0 (NULL aep + adj)
    assert rows["7"]["commission_expense"] is None and rows["7"]["aep_total"] == 0
    assert rows["7"]["net_company_dollar"] == 0 and rows["7"]["agent_split"] == 0.0


def test_splits_zero_gci_gives_zero_company_split(spark):
    df = ledger.deal_ledger(lines_df(spark, [line(1, "502001", "-50.00"), line(2, "400001", "100.00"),
                                             line(2, "502001", "-25.00")]), MAIN)
    df = df.withColumn("aep_adjusted", F.lit(None).cast("bigint"))
    rows = {r["deal_id"]: r for r in deals.with_splits(df).collect()}
    assert rows["1"]["agent_split"] == 0.0 and rows["1"]["company_split"] == 0.0
    assert rows["2"]["agent_split"] == -0.25 and rows["2"]["company_split"] == 0.75


ROSTER_SCHEMA = ("team_id string, account_team_name string, parent_account_name string, agent_role string, "
                 "primary_principal_flag string, market string, original_start_date date, separation_date date, "
                 "number_of_agents int, resource_fee_cap decimal(18,2)")


def test_roster_filters_null_parent_and_agents(spark):
    r = spark.createDataFrame([
        ("T1", "A", "P1", "Principal", "Y", "M", D(2018, 1, 1), None, 0, None),
        ("T2", "B", None, "Principal", "Y", "M", D(2018, 1, 1), None, 3, None),       # NULL parent: out
        ("T3", "C", "PARENT_2", "Principal", "Y", "M", D(2018, 1, 1), None, 3, None),  # excluded parent
        ("T4", "D", "P1", "Agent", "Y", "M", D(2018, 1, 1), None, 3, None),
        ("T5", "E", "P1", "Principal", "N", "M", D(2018, 1, 1), None, 3, None),
        ("T6", "F", "P1", "Principal", "Y", "M", None, None, 3, None),
        (None, "G", "P1", "Principal", "Y", "M", D(2018, 1, 1), None, None, None),
    ], ROSTER_SCHEMA)
    kept = principal_roster(Inputs(ledger=lambda w: None, roster=r), MAIN)
    assert sorted(x["account_team_name"] for x in kept.collect()) == ["A", "G"]
    agents = {x["account_team_name"]: x["number_of_agents"] for x in roster.roster_agents(kept).collect()}
    assert agents == {"A": 1, "G": None}
    assert [x["roster_team_id"] for x in roster.roster_slim(kept).collect()] == ["T1"]


def test_deal_fans_out_per_principal_and_null_team_never_matches(spark):
    rows = spark.createDataFrame([("1", "T1", 5), ("2", None, 6)], "deal_id string, team_id string, x long")
    slim = spark.createDataFrame([("T1", "A", 2), ("T1", "B", None)], "roster_team_id string, account_team_name string, number_of_agents int")
    out = rows_key(deals.attach_roster(rows, slim).collect())
    assert out == rows_key([(None, None, 0, "2", None, 6), ("T1", "A", 2, "1", "T1", 5), ("T1", "B", 0, "1", "T1", 5)])


def test_principal_year_counts_null_deal_once(spark):
    rows = spark.createDataFrame(
        [("T1", "2019", "ASIA", "L", "X", d, 100, 200, 300, 0) for d in (None, None, "1", "1", "2")],
        "team_id string, ending_year string, market_region string, location_name string, listing_type string, "
        "deal_id string, commission_expense long, gci_less_referral long, net_company_dollar long, aep_total long")
    slim = spark.createDataFrame([("T1", "A", "M", D(2018, 1, 1))],
                                 "roster_team_id string, account_team_name string, market string, original_start_date date")
    (r,) = principals.principal_year(rows, slim).collect()
    assert r["deal_count"] == 3 and r["gci_less_referral"] == 1000 and r["ncd_margin"] == 1.5


def test_cohort_bounds_are_strict_and_empty_cohort_has_no_rows(spark):
    bands = (CohortBand("Total Principal Cohorts"), CohortBand("early", (("<", D(2019, 1, 1)),)),
             CohortBand("mid", ((">", D(2019, 1, 1)), ("<", D(2019, 9, 1)))),
             CohortBand("none", ((">", D(2030, 1, 1)),)))
    df = spark.createDataFrame([(D(2019, 1, 1),), (D(2019, 9, 1),), (D(2019, 5, 1),), (D(2018, 5, 1),)],
                               "original_start_date date")
    got = sorted((r["cohort"], r["original_start_date"]) for r in cohorts.cohort_members(df, bands).collect())
    assert got == sorted([("Total Principal Cohorts", d) for d in (D(2019, 1, 1), D(2019, 9, 1), D(2019, 5, 1),
                                                                   D(2018, 5, 1))]
                         + [("early", D(2018, 5, 1)), ("mid", D(2019, 5, 1))])


def test_positional_share_uses_row_position(spark):
    total = "Total Principal Cohorts"
    rows = [(total, "R", "M", "L", "T1", "A", "x", 100), (total, "R", "M", "L", "T2", "B", "x", 300),
            ("c", "R", "M", "L", "T2", "B", "x", 30)]
    df = spark.createDataFrame(rows, "cohort string, market_region string, market string, location_name string, "
                                     "team_id string, account_team_name string, listing_type string, "
                                     "gci_less_referral_2019 long")
    out = {(r["cohort"], r["team_id"]): r["pct_gci_less_referral_2019"]
           for r in cohorts.positional_share(df, (2019,), total).collect()}
    # cohort 'c' has one row; position 1 meets the total row at position 1 (T1), not T2
    assert out[("c", "T2")] == 30 / 100 * 1.0 and out[(total, "T1")] == 1.0
    shares = {(r["cohort"], r["team_id"]): r["pct_gci_less_referral_2019"]
              for r in cohorts.market_total_share(df, (2019,), total).collect()}
    assert shares[("c", "T2")] == 30 / 400 and shares[(total, "T1")] + shares[(total, "T2")] == 1.0


def test_fee_department_null_never_matches_and_account_adjusted(spark):
    deals_df = spark.createDataFrame(
        [("1", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", "D", 1000, 500),
         ("2", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", None, 1000, 500)],
        "deal_id string, team_id string, ending_period date, market_region string, location_name string, "
        "side_represented string, listing_type string, department_name string, acct_430003 long, acct_430011 long")
    sums = spark.createDataFrame(
        [("1", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", "D", "430003", 100),
         ("2", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", None, "430003", 100)],
        "deal_id string, team_id string, ending_period date, market_region string, location_name string, "
        "side_represented string, listing_type string, department_name string, account_number string, "
        "flat_fees_isolated long")
    by = {r["deal_id"]: r for r in fees.fee_by_account(deals_df, sums).collect()}
    assert by["1"]["acct_430003"] == 900 and by["2"]["acct_430003"] == 1000
    iso = fees.fee_isolated_ledger(fees.fee_by_account(deals_df, sums), fees.fee_totals(sums)).collect()
    assert len(iso) == 3  # the NULL-department fee total stays a row of its own
    flat = {(r["deal_id"], r["department_name"]): r["acct_430011"] for r in iso}
    assert flat[("1", "D")] == 600 and flat[("2", None)] in (None,)


SETTINGS = {"begin": "2019-01-01", "end": "2020-12-31", "split_region": "R", "excluded_parents": [], "crosswalk": {"R": ["M"]},
            "report_years": [2019, 2020]}


def test_config_rejects_wrong_settings():
    with pytest.raises(ValueError):
        CohortBand("bad", (("=>", D(2019, 1, 1)),))
    for wrong in ({"begin": "2021-01-01"}, {"crosswalk": {}}, {"report_years": [2015, 2019]}, {"share_mode": "x"}, {"colour": 1}):
        with pytest.raises(ValueError):
            from_mapping({**SETTINGS, **wrong})
    for name in SETTINGS:
        with pytest.raises(ValueError, match=name):
            from_mapping({k: v for k, v in SETTINGS.items() if k != name})


def test_config_from_plain_values():
    cfg = from_mapping({**SETTINGS, "crosswalk": {"A": ["M", "N"], "B": "M"}, "fee_items": ["1"], "aep_cutoff": "2021-02-28",
                        "cohorts": {"Total Principal Cohorts": [], "new": [[">=", "2020-01-01"]]}})
    assert isinstance(cfg, ReportConfig) and cfg.crosswalk == (("A", "M"), ("A", "N"), ("B", "M"))
    assert cfg.fee_items == ("1",) and cfg.pivot_years == (2019, 2020, 2021)
    assert cfg.cohorts[1] == CohortBand("new", ((">=", D(2020, 1, 1)),))


def test_no_fixture_value_in_the_production_config():
    import inspect

    from dealspark import config
    text = inspect.getsource(config)
    assert not any(x in text for x in ("AMERICA", "PARENT_", "MKT_", "NATION", "ASIA"))


def test_pivot_years_cover_both_windows():
    assert MAIN.pivot_years == (2019, 2020)
    assert MAIN.with_window(D(2020, 9, 1), D(2020, 12, 31)).pivot_years == (2018, 2019, 2020)
    cfg = from_mapping({**SETTINGS, "begin": "2021-01-01", "end": "2022-12-31", "report_years": [2021, 2022]})
    assert cfg.pivot_years == (2018, 2019, 2020, 2021, 2022)


def test_ledger_contract(spark):
    df = lines_df(spark, [line(1, "400001", "1.00")])
    assert checked_ledger(df.withColumn("extra", F.lit(1))).columns == checked_ledger(df).columns
    with pytest.raises(ValueError, match="item_id"):
        checked_ledger(df.drop("item_id"))
    for column, kind in (("amount", "decimal(18,4)"), ("amount", "double"), ("ending_period", "string"), ("deal_id", "double")):
        with pytest.raises(ValueError, match=column):
            checked_ledger(df.withColumn(column, F.col(column).cast(kind)))
    assert checked_ledger(df.withColumn("amount", F.col("amount").cast("int"))).count() == 1


def test_source_names_are_mapped(spark):
    df = spark.createDataFrame([(1, "x")], "`Number of Agents` int, TEAM string")
    out = renamed(df, {"Number of Agents": "number_of_agents", "TEAM": "team_id"})
    assert out.columns == ["number_of_agents", "team_id"] and renamed(df, None).columns == df.columns
    with pytest.raises(ValueError):
        renamed(df, {"nope": "team_id"})


def test_absent_roster_columns_are_typed_nulls(spark):
    r = spark.createDataFrame([("T1", "A", "P1", "Principal", "Y", "M", D(2018, 1, 1))],
                              "team_id string, account_team_name string, parent_account_name string, agent_role string, "
                              "primary_principal_flag string, market string, original_start_date date")
    kept = principal_roster(Inputs(ledger=lambda w: None, roster=r), MAIN)
    assert kept.columns == list(ROSTER_COLUMNS) and len(kept.columns) == 30
    assert dict(kept.dtypes)["sales_manager_name"] == "string" and dict(kept.dtypes)["resource_fee_cap"] == "decimal(18,2)"
    assert roster.roster_slim(kept).first()["number_of_agents"] is None
    with pytest.raises(ValueError, match="market"):
        principal_roster(Inputs(ledger=lambda w: None, roster=r.drop("market")), MAIN)


def test_unmapped_fee_account_is_reported_not_applied(spark):
    deals_df = spark.createDataFrame(
        [("1", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", "D", 1000)],
        "deal_id string, team_id string, ending_period date, market_region string, location_name string, "
        "side_represented string, listing_type string, department_name string, acct_430003 long")
    sums = spark.createDataFrame(
        [("1", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", "D", "999999", 70)],
        "deal_id string, team_id string, ending_period date, market_region string, location_name string, "
        "side_represented string, listing_type string, department_name string, account_number string, "
        "flat_fees_isolated long")
    assert [tuple(r) for r in fees.unmapped_fee_accounts(sums).collect()] == [("999999", 1, 70)]
    (row,) = fees.fee_by_account(deals_df, sums).collect()
    assert row["acct_430003"] == 1000


def test_size_check_is_by_decoded_bytes(spark):
    from dealspark.operators.merge import fits_broadcast
    from dealspark.session import materialize_measured
    long = materialize_measured(spark.range(10_000), "size-check")
    assert (long.rows, long.bytes) == (10_000, 160_000) and long.frame.count() == 10_000
    assert fits_broadcast(long, 1 << 20) and not fits_broadcast(long, 1000)
    # One long text in every row: a dictionary of one entry in the files, two megabytes decoded.
    same = materialize_measured(spark.range(2_000).select(F.lit("x" * 1000).alias("t"), F.lit(None).cast("string").alias("n")), "size-check")
    files = sum(len(open(f.removeprefix("file:"), "rb").read()) for f in same.frame.inputFiles())
    assert files < 100_000 and same.bytes == 2_000 * (1000 + 24) and not fits_broadcast(same, 1 << 20)
    nested = materialize_measured(spark.createDataFrame([([1, 2], "é")], "a array<int>, s string"), "size-check")
    assert nested.bytes == 24 + 16 + 8
    assert materialize_measured(spark.range(0), "size-check").bytes == 0


def test_a_compressible_side_over_the_bound_is_shuffled(spark):
    import dataclasses

    from dealspark.plans.pipeline import Stages
    from dealspark.sources.extracts import fixture_view_inputs
    from dealspark.sources.fixtures import MAIN

    from .conftest import SF_SMALL
    st = Stages(spark, fixture_view_inputs(spark, SF_SMALL), dataclasses.replace(MAIN, broadcast_max_bytes=30_000))
    wide = st.roster_slim.withColumn("resource_fee_type", F.lit("y" * 20_000))
    st.__dict__["roster_slim"] = wide
    files = sum(len(open(f.removeprefix("file:"), "rb").read()) for f in st.roster_stored.frame.inputFiles())
    assert files < 30_000 < st.roster_stored.bytes
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = st.deal_data._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [line for line in plan.splitlines() if "SortMergeJoin" in line and "roster_team_id" in line]


def test_the_key_bitmap_keeps_all_that_meet(spark):
    from dealspark.operators.merge import may_meet, outer_merge
    keys = ("deal_id", "team_id")
    rows = spark.range(50_000).select(F.when(F.col("id") % 9 > 0, F.col("id").cast("string")).alias("deal_id"),
                                      F.when(F.col("id") % 5 > 0, F.concat(F.lit("T"), F.col("id") % 40)).alias("team_id"), F.col("id").alias("v"))
    side = rows.where("v % 100 = 0").select(*keys).distinct().withColumn("s", F.lit(1))
    side = side.unionByName(spark.createDataFrame([("none", "T1", 1), (None, None, 1), ("none", None, 1)], "deal_id string, team_id string, s int")).distinct()
    n = side.count()
    cond = [rows[k].eqNullSafe(side[k]) for k in keys]
    want = sorted(r["v"] for r in rows.join(side, cond[0] & cond[1], "left_semi").collect())
    for limit in (1 << 20, 4096, 1):  # the smallest bitmap is one of 4 KiB
        got = may_meet(rows, side, keys, n, limit)
        assert got.columns == rows.columns
        seen = {r["v"] for r in got.collect()}
        assert set(want) <= seen and len(seen) < len(want) + 50_000 // 8
    full = outer_merge(rows, side, null_safe=keys)
    assert rows_key(outer_merge(rows, side, null_safe=keys, side_rows=n).collect()) == rows_key(full.collect())
    strict = outer_merge(rows, side, null_safe=("deal_id",), strict=("team_id",))
    assert rows_key(outer_merge(rows, side, null_safe=("deal_id",), strict=("team_id",), side_rows=n).collect()) == rows_key(strict.collect())
    assert may_meet(rows, side.limit(0), keys, 0, 4096).count() == 0


def test_the_key_bitmap_bounds_what_the_anti_join_shuffles(spark):
    """Of 200,000 distinct ledger keys few reach the shuffle before ``distinct``."""
    from dealspark.operators.merge import outer_merge
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("deal_id"), F.col("id").alias("v"))
    side = spark.range(0, 400_000, 4_000).select(F.col("id").cast("string").alias("deal_id"), F.lit(1).alias("s"))

    def shuffled(**options):
        only = outer_merge(rows, side, null_safe=("deal_id",), **options).where("v IS NULL")
        only.collect()
        most, queue = [], [only._jdf.queryExecution().executedPlan()]
        while queue:
            node = queue.pop()
            if node.nodeName() == "AdaptiveSparkPlan":
                queue.append(node.executedPlan())
            elif node.nodeName().endswith("QueryStage"):
                queue.append(node.plan())
            elif node.nodeName() == "Exchange":
                most.append((node.child().toString().count("HashAggregate") > 0, node.metrics().apply("shuffleRecordsWritten").value()))
            children = node.children()
            queue += [children.apply(i) for i in range(children.size())]
        return max(n for aggregated, n in most if aggregated)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffled() >= 200_000 and shuffled(side_rows=100) < 100 + 200_000 // 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("rows", [1, 3000])
def test_positions_of_a_hot_market_equal_the_window(spark, rows):
    from pyspark.sql import Window
    total = "Total Principal Cohorts"
    df = spark.range(rows).select(
        F.when(F.col("id") % 3 > 0, total).otherwise("c").alias("cohort"), F.when(F.col("id") % 10 > 0, "HOT").otherwise("R").alias("market_region"),
        F.concat(F.lit("M"), F.col("id") % 3).alias("market"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("L"), F.col("id") % 5)).alias("location_name"),
        F.when(F.col("id") % 11 > 0, F.col("id").cast("string")).alias("team_id"), F.col("id").cast("string").alias("account_team_name"),
        F.lit("x").alias("listing_type"), F.col("id").alias("gci_less_referral_2019")).repartition(6)
    w = Window.partitionBy("market_region", "cohort").orderBy(*[F.coalesce(F.col(c), F.lit("tmp")) for c in cohorts.POSITION_ORDER])
    got = cohorts.with_position(df)
    assert rows_key(got.collect()) == rows_key(df.withColumn("position", F.row_number().over(w)).collect())
    shares = cohorts.market_total_share(materialize(df, "totals"), (2019,), total).collect()
    sums = {}
    for r in df.collect():
        if r["cohort"] == total:
            sums[r["market_region"]] = sums.get(r["market_region"], 0) + r["gci_less_referral_2019"]
    assert len(shares) == rows and all(r["market_gci_less_referral_2019"] == sums.get(r["market_region"]) for r in shares)


def test_deal_matched_by_two_fee_accounts_fans_out(spark):
    deals_df = spark.createDataFrame(
        [("1", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", "D", 1000, 500)],
        "deal_id string, team_id string, ending_period date, market_region string, location_name string, "
        "side_represented string, listing_type string, department_name string, acct_430003 long, acct_430011 long")
    sums = spark.createDataFrame(
        [("1", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", "D", "430003", 100),
         ("1", "T1", D(2019, 1, 31), "ASIA", "N", "R", "L", "D", "430011", 40)],
        "deal_id string, team_id string, ending_period date, market_region string, location_name string, "
        "side_represented string, listing_type string, department_name string, account_number string, "
        "flat_fees_isolated long")
    by = sorted((r["acct_430003"], r["acct_430011"]) for r in fees.fee_by_account(deals_df, sums).collect())
    assert by == [(900, 500), (1000, 460)]  # one copy per account, that account reduced
    iso = sorted(r["acct_430011"] for r in fees.fee_isolated_ledger(
        fees.fee_by_account(deals_df, sums), fees.fee_totals(sums)).collect())
    assert iso == [460 + 140, 500 + 140]  # the full total lands on each copy


PY_SCHEMA = ("team_id string, account_team_name string, ending_year string, market_region string, "
             "location_name string, listing_type string, market string, original_start_date date, "
             "commission_expense long, gci_less_referral long, net_company_dollar long, aep_total long, "
             "deal_count long, ncd_margin double")


def test_pivot_missing_year_is_null_and_not_producing(spark):
    py = spark.createDataFrame(
        [("T1", "A", "2020", "ASIA", "X", "L", "MKT_0", D(2018, 1, 1), -10, 100, 90, 0, 2, 0.9),
         ("T2", "B", "2018", "ASIA", "X", "L", "MKT_0", D(2018, 1, 1), -10, 100, 90, 0, 1, 0.9)], PY_SCHEMA)
    piv = principals.principal_pivot(py, (2019, 2020))
    flagged = {r["team_id"]: r for r in principals.with_producing_flags(piv, (2019, 2020)).collect()}
    assert flagged["T1"]["gci_less_referral_2019"] is None and flagged["T1"]["deal_count_2020"] == 2
    assert flagged["T1"]["num_producing_principals_2019"] == 0
    assert flagged["T1"]["num_producing_principals_2020"] == 1
    # a principal active only outside the report years keeps its row, all NULL
    assert flagged["T2"]["gci_less_referral_2020"] is None and flagged["T2"]["num_producing_principals_2020"] == 0


def test_duplicate_crosswalk_pair_does_not_duplicate_rows(spark):
    import dataclasses
    cfg = dataclasses.replace(MAIN, crosswalk=(("ASIA", "MKT_0"), ("ASIA", "MKT_0"), ("ASIA", "MKT_1")))
    piv = spark.createDataFrame([("T1", "ASIA", "MKT_0"), ("T2", "ASIA", "MKT_2"), ("T3", None, "MKT_0")],
                                "team_id string, market_region string, market string")
    kept = principals.market_scope(piv, principals.crosswalk_frame(spark, cfg))
    assert [r["team_id"] for r in kept.collect()] == ["T1"]


def test_money_leaves_as_the_double_of_the_exact_decimal(spark):
    from dealspark.functions.columns import money_to_double
    from dealspark.functions.money import is_money, to_cents

    assert is_money("gci_less_referral_2019") and is_money("acct_430011")
    assert not any(map(is_money, ("deal_count_2019", "acct_manager", "amount_due", "aep_rank")))
    df = spark.createDataFrame([(Decimal("1234.56"), 7, Decimal("-0.10"))], "amount decimal(18,2), deal_count long, cap decimal(18,2)")
    cents = df.select(to_cents(F.col("amount")).alias("amount"), "deal_count", "cap")
    out = money_to_double(cents)
    assert dict(out.dtypes) == {"amount": "double", "deal_count": "bigint", "cap": "double"}
    (r,) = out.collect()
    assert r["amount"] == 1234.56 and r["deal_count"] == 7 and r["cap"] == -0.1


def test_money_is_written_as_exact_decimal(spark):
    from dealspark.functions.columns import money_to_decimal
    df = spark.createDataFrame([(123456789101, Decimal("-0.10"), 0.5, 3), (None, None, None, None)],
                               "acct_400001 long, cap decimal(18,2), agent_split double, deal_count long")
    out = money_to_decimal(df)
    assert dict(out.dtypes) == {"acct_400001": "decimal(38,2)", "cap": "decimal(38,2)", "agent_split": "double", "deal_count": "bigint"}
    a, b = out.collect()
    assert tuple(a) == (Decimal("1234567891.01"), Decimal("-0.10"), 0.5, 3) and tuple(b) == (None,) * 4
