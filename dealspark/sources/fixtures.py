"""The two input relations realised over the driver's TPC-H-style tables.

A real deployment points ``ledger_lines`` / ``principal_roster`` at its own
tables (``extracts.table_inputs``); these builders give the same schema over
``{sf_dir}/*.parquet`` so every query grows with the generated data.  The
mapping is the one specified in FIXTURES.md; the DuckDB oracles carry the same
text as SQL.

Plan shape: orders join customer first (the narrower fact) with nation and
region broadcast (25 and 5 rows, fixed by the schema), then lineitem joins on
the order key, so lineitem is shuffled once.  The account slot is an array
lookup, not a join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ReportConfig, crosswalk_pairs
from ..functions.chart import ACCOUNTS

# --- fixed values -----------------------------------------------------------
# Fixture account slots 0..31, in slot order.
FIXTURE_ACCOUNT_SLOTS = (
    "400001", "400002", "400003", "400004", "400005", "400006", "400007", "400009",
    "401001", "410001", "411001", "502001", "502006", "503001", "510002", "510003",
    "510004", "510005", "510006", "400090", "400097", "400098", "400099", "401002",
    "401003", "401004", "430001", "430002", "430003", "430006", "430009", "430011",
)
# Account of the lines with l_partkey % 97 = 5, outside the chart.
FIXTURE_OTHER_ACCOUNT = "439901"
# Fixture item ids by l_partkey % 12 for residues 0..4 (other residues: '1').
FIXTURE_ITEM_IDS = ("470", "469", "111", "86", "799")
# Roster start dates by s_suppkey % 8 for residues 0..4 (other residues: 2017-03-01).
FIXTURE_START_DATES = ("2019-01-01", "2019-09-01", "2019-05-15", "2020-02-10", "2020-10-01")
# ---------------------------------------------------------------------------

assert sorted(FIXTURE_ACCOUNT_SLOTS) == sorted(ACCOUNTS)

# Configurations over the fixture tables (FIXTURES.md section 3).
FIXTURE_CROSSWALK = crosswalk_pairs(
    {
        "ASIA": ["MKT_0", "MKT_1"],
        "EUROPE": "MKT_2",
        "AFRICA": "MKT_0",
        "MIDDLE EAST": "MKT_1",
        "AMERICA": "MKT_0",
        "NATION_1": "MKT_1",
    }
)
MAIN = ReportConfig(begin=dt.date(2019, 1, 1), end=dt.date(2020, 12, 31), split_region="AMERICA",
                    excluded_parents=("PARENT_2",), crosswalk=FIXTURE_CROSSWALK, report_years=(2019, 2020))
LATE = MAIN.with_window(dt.date(2020, 9, 1), dt.date(2020, 12, 31))

YEARS_SHIFT_MONTHS = 240  # fixture dates move by 20 years


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _prefixed(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def ledger_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ledger lines, plus the source order timestamp ``_order_ts`` that
    ``window`` uses to bound the scan."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = F.broadcast(
        _table(spark, sf_dir, "nation")
        .join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    order_side = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        geo, F.col("c_nationkey") == F.col("n_nationkey")
    )
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    df = lines.join(order_side, F.col("l_orderkey") == F.col("o_orderkey"))

    ok, ck, pk = F.col("o_orderkey"), F.col("o_custkey"), F.col("l_partkey")
    slots = F.array(*[F.lit(a) for a in FIXTURE_ACCOUNT_SLOTS])
    account = F.when(pk % 97 == 5, F.lit(FIXTURE_OTHER_ACCOUNT)).otherwise(
        F.element_at(slots, ((pk + F.col("l_linenumber")) % 32 + 1).cast("int")))
    close_date = F.add_months(F.to_date("o_orderdate"), YEARS_SHIFT_MONTHS)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    item_ids = F.array(*[F.lit(i) for i in FIXTURE_ITEM_IDS])
    return df.select(
        _null_when(ok % 11 == 0, ok).alias("deal_id"),
        _null_when(ok % 22 == 0, ok).alias("deal_line_id"),
        _null_when(ck % 13 == 0, F.when(ck % 8 == 5, _prefixed("T", ck % 3)).otherwise(_prefixed("T", F.floor(ck / 30)))).alias("team_id"),
        F.col("r_name").alias("market_region"),
        _null_when(ok % 17 == 0, F.concat(F.col("n_name"), F.lit(", "), F.col("r_name"))).alias("location_name"),
        _null_when(ok % 19 == 0, F.col("c_mktsegment")).alias("department_name"),
        F.col("l_returnflag").alias("side_represented"),
        _null_when(ok % 23 == 0, F.col("o_orderpriority")).alias("listing_type"),
        close_date.alias("close_date"),
        F.last_day(close_date).alias("ending_period"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("final_close_price"),
        _prefixed("V", ck % 50).alias("vendor_agent_id"),
        _prefixed("C", ck % 7).alias("company_agent_id"),
        account.alias("account_number"),
        F.when((account == "502001") & (F.col("l_orderkey") % 3 == 0), F.lit("AEP"))
        .otherwise(F.lit("STD"))
        .alias("item_type_name"),
        F.when(pk % 12 < 5, F.element_at(item_ids, (pk % 12 + 1).cast("int"))).otherwise(F.lit("1")).alias("item_id"),
        F.when(pk % 12 < 5, F.lit("flat fee")).otherwise(F.lit("other")).alias("item_name"),
        F.when((F.col("l_orderkey") + pk) % 101 == 0, F.lit(None).cast("decimal(18,2)"))
        .when((account >= "500000") | account.startswith("4010"), -price)
        .otherwise(price)
        .alias("amount"),
        F.col("o_orderdate").alias("_order_ts"),
    )


def window(base: DataFrame, period: tuple[dt.date, dt.date] | None) -> DataFrame:
    """Ledger lines (schema: FIXTURES.md section 1) whose ``ending_period``
    lies in ``period`` (None: all).  The window is also stated as a range on
    the source order date, which Catalyst pushes into the orders scan; the
    exact filter on the derived column stays."""
    if period is None:
        return base.drop("_order_ts")
    # ending_period = last_day(order month + 240 months) lies in [lo, hi] only
    # if the order month lies in [lo's month, hi's month] - 240 months.
    lo, hi = period
    lo_src = dt.datetime(lo.year - 20, lo.month, 1)
    hi_src = dt.datetime(hi.year - 20 + hi.month // 12, hi.month % 12 + 1, 1)
    ts = base.schema["_order_ts"].dataType.simpleString()
    return base.filter(
        (F.col("_order_ts") >= F.lit(lo_src).cast(ts))
        & (F.col("_order_ts") < F.lit(hi_src).cast(ts))
        & F.col("ending_period").between(F.lit(lo), F.lit(hi))
    ).drop("_order_ts")


def ledger_lines(spark: SparkSession, sf_dir: str, period: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Accounting ledger lines, optionally restricted to a period window."""
    return window(ledger_base(spark, sf_dir), period)


def text_id_lines(lines: DataFrame) -> DataFrame:
    """Ledger lines as a source with text ids may deliver them: numbers with
    decimals, now and then a text that is none, and amounts of any size
    (FIXTURES.md section 6)."""
    deal, amount = F.col("deal_id"), F.col("amount").cast("decimal(38,2)")
    return lines.withColumns({
        "deal_id": F.when(deal % 29 == 0, F.lit("n/a")).otherwise(F.concat(deal.cast("string"), F.lit(".0"))),
        "deal_line_id": F.when(F.col("deal_line_id") % 37 == 0, F.lit("?")).otherwise(F.col("deal_line_id").cast("string")),
        "amount": F.when(F.abs(amount) % 211 < 1, amount * F.lit(10**15).cast("decimal(16,0)")).otherwise(amount).cast("decimal(38,2)"),
        "ending_period": _null_when(F.col("final_close_price") % 97 < 1, F.col("ending_period")),
    })


def principal_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Principal-agent roster history (schema: FIXTURES.md section 1)."""
    s = _table(spark, sf_dir, "supplier")
    sk = F.col("s_suppkey")
    start = F.when(sk % 14 == 13, F.lit(None).cast("date"))
    for residue, day in enumerate(FIXTURE_START_DATES):
        start = start.when(sk % 8 == residue, F.lit(dt.date.fromisoformat(day)))
    start = start.otherwise(F.lit(dt.date(2017, 3, 1)))
    day = dt.date(2018, 1, 1)
    return s.select(
        _prefixed("A", sk).alias("agent_id"),
        _null_when(sk % 31 == 30, _prefixed("T", F.floor(sk / 2))).alias("team_id"),
        F.col("s_name").alias("account_team_name"),
        _null_when(sk % 9 == 8, _prefixed("PARENT_", sk % 9)).alias("parent_account_name"),
        F.concat(F.lit("Agent "), F.col("s_name")).alias("agent_name"),
        F.when(sk % 6 == 5, F.lit("Agent")).otherwise(F.lit("Principal")).alias("agent_role"),
        _null_when(sk % 7 == 6, _prefixed("Manager ", sk % 7)).alias("sales_manager_name"),
        F.when(sk % 10 == 7, F.lit("N")).otherwise(F.lit("Y")).alias("primary_principal_flag"),
        _prefixed("MKT_", sk % 3).alias("market"),
        _prefixed("SUB_", sk % 5).alias("sub_market"),
        _prefixed("Office ", sk % 11).alias("office"),
        F.when(sk % 4 == 3, F.lit("Inactive")).otherwise(F.lit("Active")).alias("contact_status"),
        start.alias("original_start_date"),
        (sk % 4).cast("int").alias("number_of_agents"),
        F.date_add(F.lit(day), (sk % 365).cast("int")).alias("contract_start_date"),
        _null_when(sk % 3 == 2, F.date_add(F.lit(day), (sk % 365 + 730).cast("int"))).alias("contract_end_date"),
        F.date_add(F.lit(day), (sk % 365 + 900).cast("int")).alias("ica_expiration_date"),
        F.when(sk % 5 == 0, F.lit(dt.date(2021, 1, 31))).alias("separation_date"),
        F.when(sk % 5 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("separated_flag"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("opportunity_gci"),
        _null_when(sk % 8 == 7, (sk % 100).cast("decimal(18,2)")).alias("total_split"),
        (sk % 90).cast("decimal(18,2)").alias("base_split"),
        F.when(sk % 2 == 0, F.lit("Flat")).otherwise(F.lit("Percent")).alias("resource_fee_type"),
        _null_when(sk % 6 == 4, _prefixed("Option ", sk % 6)).alias("resource_fee_option"),
        (sk % 20).cast("decimal(18,2)").alias("resource_fee_pct"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("resource_fee_cap"),
        _null_when(sk % 12 == 11, (sk % 500).cast("decimal(18,2)")).alias("actual_resource_fee"),
        (sk % 400).cast("decimal(18,2)").alias("policy_resource_fee"),
        _prefixed("AMA", sk).alias("ama_id"),
        _prefixed("C", sk).alias("contact_id"),
        _prefixed("ACC", sk).alias("account_id"),
    )
