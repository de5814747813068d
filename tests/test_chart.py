"""Charts of accounts from outside: a table, the settings, the command line."""

import json

import pytest
from pyspark.sql import functions as F

from dealspark.config import from_mapping
from dealspark.functions.chart import COMPOSITES, DEFAULT_CHART, MOST_ACCOUNTS, Chart, chart_from_mapping, chart_from_table
from dealspark.operators import fees
from dealspark.plans.operations import SECOND_CHART, second_company
from dealspark.plans.pipeline import Stages
from dealspark.sources.extracts import fixture_view_inputs, store_inputs
from dealspark.sources.sinks import read_outputs

from .conftest import SF_SMALL

SCHEMA = "position int, account string, measures array<string>, flat_fee boolean"
NONE = tuple((n, ()) for n, _ in COMPOSITES)


def test_a_chart_from_a_table_keeps_its_order(spark):
    chart = chart_from_table(spark.createDataFrame(SECOND_CHART, SCHEMA).repartition(3))
    assert chart.accounts == tuple(a for _, a, _, _ in SECOND_CHART) and chart.flat_fee_account == "430003"
    assert dict(chart.composites) == {"total_gci": ("439901", "400001", "400099"), "total_referral": ("510002",),
                                      "commission_expense": ("502001", "503001"), "aep": ("502006",)}


@pytest.mark.parametrize("rows,error", [
    ([(1, "1", [], False)], "flat fees"), ([(1, "1", [], True), (2, "2", [], True)], "flat fees"), ([(1, "1", ["gross"], True)], "unknown measures"),
    ([(1, "1", [], True), (2, "1", [], False)], "twice"), ([(1, "x'y", [], True)], "form"), ([], "flat fees"),
    ([(i, str(i), None, i == 0) for i in range(MOST_ACCOUNTS + 1)], "accounts"),
])
def test_broken_charts_fail(spark, rows, error):
    with pytest.raises(ValueError, match=error):
        chart_from_table(spark.createDataFrame(rows, SCHEMA))


def test_charts_from_settings():
    values = {"accounts": ["1", "2"], "composites": {"aep": ["2"]}, "flat_fee_account": "1"}
    assert chart_from_mapping(values) == Chart(("1", "2"), (*NONE[:3], ("aep", ("2",))), "1")
    with pytest.raises(ValueError, match="not in the chart"):
        chart_from_mapping({**values, "flat_fee_account": "3"})
    with pytest.raises(ValueError, match="missing or unknown"):
        chart_from_mapping({"accounts": ["1"]})
    with pytest.raises(ValueError, match="unknown measures"):
        chart_from_mapping({**values, "composites": {"x": []}})
    settings = {"begin": "2019-01-01", "end": "2020-12-31", "split_region": "A", "excluded_parents": [], "crosswalk": {"A": "M"}, "report_years": [2019, 2020]}
    assert from_mapping(settings).chart == DEFAULT_CHART and from_mapping({**settings, "chart": values}).chart.accounts == ("1", "2")


def test_fees_adjust_the_columns_of_the_chart(spark):
    cfg = second_company(spark)
    st = Stages(spark, fixture_view_inputs(spark, SF_SMALL), cfg)
    assert [c for c in st.deal_data.columns if c.startswith("acct_")] == list(cfg.chart.columns)
    isolated = st.fee_isolated_ledger
    assert isolated.where("acct_430003 IS NOT NULL").count() > 0
    unmapped = {r["account_number"] for r in st.unmapped_fee_accounts.collect()}
    assert unmapped and not unmapped & set(cfg.chart.accounts)
    before = st.reclassed.agg(F.sum("acct_400001")).first()[0]
    sums = st.fee_sums.where("account_number = '400001'")
    assert sums.count() > 0
    one = fees.fee_by_account(st.reclassed, sums, chart=cfg.chart)
    assert one.agg(F.sum("acct_400001")).first()[0] < before


def test_the_command_line_takes_a_chart(spark, tmp_out):
    from dealspark.__main__ import main

    spark.createDataFrame(SECOND_CHART, SCHEMA).write.parquet(f"{tmp_out}/chart")
    main(["--fixtures", SF_SMALL, "--out", f"{tmp_out}/out", "--run-date", "2026-02-03", "--chart", f"{tmp_out}/chart"])
    back = read_outputs(spark, f"{tmp_out}/out")["deal_data"]
    assert [c for c in back.columns if c.startswith("acct_")] == [f"acct_{a}" for _, a, _, _ in SECOND_CHART] and back.count() > 0


def test_the_command_line_keeps_stages(spark, tmp_out):
    import os

    from dealspark.__main__ import main
    from dealspark.sources.fixtures import MAIN

    paths = store_inputs(fixture_view_inputs(spark, SF_SMALL), tmp_out)
    settings = {"begin": "2019-01-01", "end": "2020-12-31", "split_region": MAIN.split_region, "excluded_parents": list(MAIN.excluded_parents),
                "crosswalk": {"ASIA": ["MKT_0"]}, "report_years": [2019, 2020]}
    with open(f"{tmp_out}/c.json", "w") as f:
        json.dump(settings, f)
    call = ["--ledger", paths[0], "--roster", paths[1], "--config", f"{tmp_out}/c.json", "--out", f"{tmp_out}/out", "--stages", f"{tmp_out}/stages"]
    main(call)
    (key,) = os.listdir(f"{tmp_out}/stages")
    kept = sorted(os.listdir(f"{tmp_out}/stages/{key}"))
    main(call)
    assert kept == sorted(os.listdir(f"{tmp_out}/stages/{key}")) and any(k.startswith("deal_rows") for k in kept)
