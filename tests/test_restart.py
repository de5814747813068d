"""A rerun goes on after the last finished stage."""

import datetime as dt
import os
from dataclasses import replace

import pytest

from dealspark.plans import pipeline
from dealspark.plans.restart import StageStore
from dealspark.sources.extracts import fixture_view_inputs
from dealspark.sources.fixtures import MAIN
from dealspark.sources.sinks import read_outputs

from .conftest import SF_SMALL

DAY = dt.date(2026, 1, 1)


@pytest.fixture(scope="module")
def inputs(spark):
    return replace(fixture_view_inputs(spark, SF_SMALL), version=lambda: "v1")


def unreadable(inputs, version="v1"):
    def fails(window):
        raise AssertionError("the ledger was read")
    return replace(inputs, ledger=fails, version=lambda: version)


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_a_rerun_after_deal_rows_does_not_read_the_ledger(spark, inputs, tmp_out, monkeypatch):
    kept, out = f"{tmp_out}/stages", f"{tmp_out}/out"
    with monkeypatch.context() as m:
        m.setattr(pipeline.principals, "with_producing_flags", lambda *a: (_ for _ in ()).throw(RuntimeError("broken")))
        with pytest.raises(RuntimeError, match="broken"):
            pipeline.run(spark, inputs, MAIN, out, DAY, fmt="parquet", stage_root=kept)
    store = StageStore(spark, kept, MAIN, "v1")
    assert store.finished("deal_rows") and not store.finished("principal_data")
    pipeline.run(spark, unreadable(inputs), MAIN, out, DAY, fmt="parquet", stage_root=kept)
    assert store.finished("principal_data")
    pipeline.run(spark, inputs, MAIN, f"{tmp_out}/plain", DAY, fmt="parquet")
    got, want = read_outputs(spark, out), read_outputs(spark, f"{tmp_out}/plain")
    for name in want:
        assert rows(got[name]) == rows(want[name]), name


def test_a_half_written_stage_is_not_used(spark, tmp_out):
    store = StageStore(spark, tmp_out, MAIN, "v1")
    bad = spark.range(10).selectExpr("if(id < 9, id, raise_error('broken')) AS id")
    with pytest.raises(Exception, match="broken"):
        store.get("stage", lambda: bad)
    assert not store.finished("stage")
    assert store.get("stage", lambda: spark.range(3)).count() == 3
    assert store.get("stage", lambda: bad).count() == 3


def test_other_settings_or_inputs_start_anew(spark, inputs, tmp_out):
    keys = {StageStore(spark, tmp_out, cfg, v).key for cfg in (MAIN, replace(MAIN, split_region="ASIA")) for v in ("v1", "v2")}
    assert len(keys) == 4
    with pytest.raises(ValueError, match="version"):
        pipeline.run(spark, replace(inputs, version=None), MAIN, tmp_out, DAY, stage_root=tmp_out)
    StageStore(spark, tmp_out, MAIN, "v1").get("s", lambda: spark.range(1))
    with pytest.raises(AssertionError, match="ledger was read"):
        pipeline.run(spark, unreadable(inputs, "v2"), MAIN, f"{tmp_out}/o", DAY, stage_root=tmp_out)


def test_old_stages_of_other_keys_are_removed(spark, tmp_out):
    old, now = StageStore(spark, tmp_out, MAIN, "v1"), StageStore(spark, tmp_out, MAIN, "v2")
    for store in (old, now):
        store.get("s", lambda: spark.range(2))
    assert now.remove_old(older_than_hours=1) == []
    assert now.remove_old(older_than_hours=-1) == [old.key]
    assert os.listdir(tmp_out) == [now.key] and now.finished("s") and not old.finished("s")


def test_the_version_of_a_ledger_store_follows_its_deliveries(spark, inputs, tmp_out):
    from dealspark.sources.ledger_store import LedgerStore
    lines = inputs.ledger((dt.date(2020, 1, 1), dt.date(2020, 2, 29)))
    store = LedgerStore(spark, tmp_out, MAIN)
    store.deliver(lines, "one")
    kept = store.inputs(inputs.roster, "r1")
    first = kept.version()
    assert first == kept.version() != store.inputs(inputs.roster, "r2").version()
    assert store.inputs(inputs.roster).version is None
    store.deliver(lines.limit(3), "two")
    assert kept.version() != first


def test_the_version_of_stored_tables_follows_their_files(spark, tmp_out):
    from dealspark.sources.files import fingerprint
    spark.range(3).write.parquet(f"{tmp_out}/a")
    one = fingerprint(spark, [f"{tmp_out}/a"])
    assert one == fingerprint(spark, [f"{tmp_out}/a"])
    spark.range(1).write.mode("append").parquet(f"{tmp_out}/a")
    assert one != fingerprint(spark, [f"{tmp_out}/a"])
