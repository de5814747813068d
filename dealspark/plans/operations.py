"""Named queries over how the job keeps and publishes its results: each stores
what it needs in the checkpoint folder, from the whole given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chart import chart_from_table
from ..functions.columns import money_to_double
from ..operators.ledger import accounts_outside, deal_ledger
from ..session import ensure_checkpoint_dir, shuffles_freed
from ..sources import sinks
from ..sources.extracts import fixture_view_inputs, quarantined
from ..sources.fixtures import MAIN, text_id_lines
from ..sources.ledger_store import LedgerStore
from .colocated import BucketedStages
from .pipeline import Stages, run

Query = Callable[[SparkSession, str], DataFrame]
RUN_DATE = dt.date(2026, 1, 1)
NULL_LABEL = "tmp"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _published(spark: SparkSession, sf_dir: str) -> str:
    base = _folder(spark, "published")
    run(spark, fixture_view_inputs(spark, sf_dir), MAIN, base, RUN_DATE, fmt="csv", null_label=NULL_LABEL)
    return base


def published(name: str) -> Query:
    """The job's CSV output read back through the manifest."""
    return lambda spark, sf_dir: money_to_double(sinks.read_outputs(spark, _published(spark, sf_dir))[name])


def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the row counts that the manifest took while the outputs were written."""
    manifest = sinks.read_manifest(spark, _published(spark, sf_dir))
    return spark.createDataFrame([(n, o["rows"]) for n, o in manifest["outputs"].items()], "output string, n_rows long")


def split_ledger(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A first delivery, and a second one with the last quarter of 2020 and
    late lines: one item's of every March."""
    late = (F.col("ending_period") >= dt.date(2020, 10, 1)) | ((F.month("ending_period") == 3) & (F.col("item_id") == "799"))
    # Bare where it is wanted: what it says of one side of a join then reaches that side.
    return ledger.where(~F.coalesce(late, F.lit(False))), ledger.where(late)


def incremental(stage: str) -> Query:
    """A stage over the kept sums of two deliveries."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = fixture_view_inputs(spark, sf_dir)
        store = LedgerStore(spark, _folder(spark, "ledger"), MAIN)
        for name, lines in zip(("first", "second"), split_ledger(inputs.ledger(None))):
            store.deliver(lines, name)
        stages = Stages(spark, store.inputs(inputs.roster), MAIN)
        if stage != "transactions":  # as the job does: the shuffles of the AEP merge end before the roster join's begin
            with shuffles_freed(spark):
                stages.store("deal_rows")
        return money_to_double(stages.extracts.transactions if stage == "transactions" else getattr(stages, stage))
    return q


# --- fixed values -----------------------------------------------------------
# A second company's chart: position, account, measures, whether it carries flat fees.
SECOND_CHART = (
    (1, "439901", ["total_gci"], False), (2, "400001", ["total_gci"], False), (3, "400099", ["total_gci"], False),
    (4, "510002", ["total_referral"], False), (5, "502001", ["commission_expense"], False),
    (6, "503001", ["commission_expense"], False), (7, "502006", ["aep"], False), (8, "430003", [], True),
)
# ---------------------------------------------------------------------------


def second_company(spark: SparkSession):
    """The configuration with the second chart, read from a table."""
    table = spark.createDataFrame(SECOND_CHART, "position int, account string, measures array<string>, flat_fee boolean")
    return replace(MAIN, chart=chart_from_table(table))


def deal_ledger_second_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2: the deal ledger by a chart from a table."""
    cfg = second_company(spark)
    return money_to_double(deal_ledger(fixture_view_inputs(spark, sf_dir).ledger((cfg.begin, cfg.end)), cfg))


def accounts_outside_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: what the second chart leaves out of the whole ledger."""
    return money_to_double(accounts_outside(fixture_view_inputs(spark, sf_dir).ledger(None), second_company(spark).chart))


def colocated(stage: str) -> Query:
    """A stage over bucketed tables."""
    return lambda spark, sf_dir: money_to_double(getattr(BucketedStages(spark, fixture_view_inputs(spark, sf_dir), MAIN), stage))


def _text_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected lines of a ledger with text ids."""
    return quarantined(text_id_lines(fixture_view_inputs(spark, sf_dir).ledger(None)))


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines set aside, with their reason."""
    columns = ("reason", "deal_id", "deal_line_id", "account_number", "ending_period", "amount")
    return money_to_double(_text_lines(spark, sf_dir)[1].select(*columns))


def deal_ledger_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 over the lines that are left."""
    lines = _text_lines(spark, sf_dir)[0].where(F.col("ending_period").between(MAIN.begin, MAIN.end))
    return money_to_double(deal_ledger(lines, MAIN))


def operations() -> dict[str, Query]:
    return {
        **{f"published_{name}": published(name) for name in sinks.OUTPUT_NAMES},
        "published_rows": published_rows,
        "deal_ledger_incremental": incremental("transactions"),
        "deal_data_incremental": incremental("deal_data"),
        "deal_aep_outer_colocated": colocated("deal_aep_outer"),
        "deal_data_colocated": colocated("deal_data"),
        "principal_data_colocated": colocated("principal_data"),
        "rejected_lines": rejected_lines,
        "deal_ledger_accepted": deal_ledger_accepted,
        "deal_ledger_second_chart": deal_ledger_second_chart,
        "accounts_outside_chart": accounts_outside_chart,
    }
