"""The whole job: three outputs read back with the values of the oracle, CSV
details, the command line over stored tables of another company."""

import datetime as dt
import json
import os
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from dealspark.plans import oracle
from dealspark.plans.pipeline import run
from dealspark.sources.extracts import fixture_view_inputs, store_inputs
from dealspark.sources.fixtures import MAIN
from dealspark.sources import files
from dealspark.sources.sinks import OUTPUT_NAMES, read_manifest, read_outputs, remove_unpublished, write_frame, write_outputs

from .compare import duck, table_digest
from .conftest import SF_SMALL

QUERY_OF = {"deal_data": "deal_data", "principal_data": "principal_data", "principal_mix_data": "cohort_mix"}


def as_doubles(df):
    return df.select(*[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in df.dtypes])


def check_outputs(frames, case):
    con = duck(SF_SMALL)
    for name, df in frames.items():
        res = con.execute(oracle.oracle_queries(case)[QUERY_OF[name]])
        columns, rows = [c[0] for c in res.description], res.fetchall()
        df = as_doubles(df)
        assert table_digest(df.columns, [tuple(r) for r in df.collect()]) == table_digest(columns, rows), name
        assert rows, name


def test_outputs_read_back_with_the_oracle_values(spark, tmp_out):
    day = dt.date(2026, 1, 2)
    inputs = fixture_view_inputs(spark, SF_SMALL)
    paths = run(spark, inputs, MAIN, tmp_out, day, fmt="parquet")
    assert all(f"{name}/run_date=2026-01-02/run=" in path for name, path in paths.items())
    schemas = {n: spark.read.parquet(p).schema for n, p in paths.items()}
    check_outputs(read_outputs(spark, tmp_out), oracle.MAIN)
    # a rerun on the same day replaces that day's output, here by CSV
    paths = run(spark, inputs, MAIN, tmp_out, day, fmt="csv")
    back = read_outputs(spark, tmp_out, day)
    assert {n: df.schema for n, df in back.items()} == schemas
    check_outputs(back, oracle.MAIN)
    for n, p in paths.items():
        text = spark.read.option("header", True).csv(p)
        money = [f.name for f in schemas[n].fields if f.dataType.simpleString().startswith("decimal")]
        assert money and text.where(" OR ".join(f"`{c}` LIKE '%E%'" for c in money)).count() == 0


def test_csv_nulls_empty_texts_and_large_amounts(spark, tmp_out):
    df = spark.createDataFrame([(1, None, Decimal("123456789.10"), dt.date(2020, 1, 2)), (2, "", Decimal("-10000000.00"), None), (3, "a,\"b", None, None)],
                               "i int, s string, m decimal(38,2), d date")

    def written(name, **options):
        write_frame(df.coalesce(1), f"{tmp_out}/{name}", **options)
        (part,) = [f for f in os.listdir(f"{tmp_out}/{name}") if f.startswith("part-")]
        return open(f"{tmp_out}/{name}/{part}").read().splitlines()

    assert written("plain") == ["i,s,m,d", "1,,123456789.10,2020-01-02", '2,"",-10000000.00,', '3,"a,\\"b",,']
    # The label stands in the named columns only: a missing number stays empty.
    assert written("label", null_label="tmp", labelled_columns=("s", "d")) == [
        "i,s,m,d", "1,tmp,123456789.10,2020-01-02", '2,"",-10000000.00,tmp', '3,"a,\\"b",,tmp']


def small_outputs(spark, n):
    return {name: spark.range(n).select(F.col("id").alias("k"), F.lit(name).alias("name")) for name in OUTPUT_NAMES}


def published(spark, base, day=None):
    return {n: sorted(r["k"] for r in df.collect()) for n, df in read_outputs(spark, base, day).items()}


@pytest.mark.parametrize("broken", [0, 2])
@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_run_that_breaks_leaves_the_outputs_published_before(spark, tmp_out, broken, fmt):
    yesterday, today = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    write_outputs(small_outputs(spark, 3), tmp_out, yesterday, fmt)
    before = {n: [0, 1, 2] for n in OUTPUT_NAMES}
    bad = small_outputs(spark, 5)
    name = OUTPUT_NAMES[broken]
    bad[name] = bad[name].withColumn("k", F.when(F.col("k") < 4, F.col("k")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        write_outputs(bad, tmp_out, today, fmt)
    assert published(spark, tmp_out) == before and read_manifest(spark, tmp_out)["run_date"] == "2026-01-01"
    with pytest.raises(Exception, match="broken"):  # a rerun of the same day
        write_outputs(bad, tmp_out, yesterday, fmt)
    assert published(spark, tmp_out, yesterday) == before
    write_outputs(small_outputs(spark, 4), tmp_out, today, fmt)
    assert published(spark, tmp_out) == {n: [0, 1, 2, 3] for n in OUTPUT_NAMES} and published(spark, tmp_out, yesterday) == before
    assert {n: o["rows"] for n, o in read_manifest(spark, tmp_out, today)["outputs"].items()} == {n: 4 for n in OUTPUT_NAMES}


def test_only_old_folders_that_no_manifest_names_are_removed(spark, tmp_out):
    day = dt.date(2026, 1, 1)
    first = write_outputs(small_outputs(spark, 1), tmp_out, day)
    second = write_outputs(small_outputs(spark, 2), tmp_out, day)
    assert remove_unpublished(spark, tmp_out, older_than_hours=1) == []  # a run may be writing
    gone = remove_unpublished(spark, tmp_out, older_than_hours=-1)
    assert sorted(p.removeprefix("file:") for p in gone) == sorted(first.values())
    assert all(os.path.isdir(p) for p in second.values()) and not any(os.path.isdir(p) for p in first.values())
    assert published(spark, tmp_out) == {n: [0, 1] for n in OUTPUT_NAMES}


def test_a_manifest_is_replaced_in_one_step(spark, tmp_out):
    for text in ("one", "zwei", "drei \u00e9"):
        files.replace_text(spark, f"{tmp_out}/m/x.json", text)
        assert files.read_text(spark, f"{tmp_out}/m/x.json") == text
    assert [e.name for e in files.listed(spark, f"{tmp_out}/m") if not e.name.startswith(".")] == ["x.json"]
    assert files.listed(spark, f"{tmp_out}/none") == []
    with pytest.raises(FileNotFoundError):
        read_manifest(spark, f"{tmp_out}/none")


# Another company: other split region, excluded parents, crosswalk, window and years.
OTHER = SimpleNamespace(begin="2018-01-01", end="2019-06-30", side_begin="2018-01-01", years=(2018, 2019, 2020), pair=(2018, 2019),
                        split="EUROPE", excluded=("PARENT_1", "PARENT_4"),
                        crosswalk=(("AMERICA", "MKT_0"), ("AMERICA", "MKT_1"), ("ASIA", "MKT_2"), ("NATION_3", "MKT_0"), ("NATION_8", "MKT_1")))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored"))
    views = fixture_view_inputs(spark, SF_SMALL)
    named = views.roster.withColumnRenamed("number_of_agents", "Number of Agents").withColumnRenamed("market", "Market Name")
    ledger = views.ledger(None).withColumnRenamed("amount", "LINE_AMOUNT")
    from dealspark.sources.extracts import Inputs
    return store_inputs(Inputs(ledger=lambda w: ledger, roster=named), root)


def settings(case):
    crosswalk = {}
    for region, market in case.crosswalk:
        crosswalk.setdefault(region, []).append(market)
    return {"begin": case.begin, "end": case.end, "split_region": case.split, "excluded_parents": list(case.excluded),
            "crosswalk": crosswalk, "report_years": list(case.pair), "ledger_names": {"LINE_AMOUNT": "amount"},
            "roster_names": {"Number of Agents": "number_of_agents", "Market Name": "market"}}


def test_command_line_over_stored_tables_of_another_company(spark, stored, tmp_out):
    from dealspark.__main__ import main

    with open(f"{tmp_out}/config.json", "w") as f:
        json.dump(settings(OTHER), f)
    paths = main(["--ledger", stored[0], "--roster", stored[1], "--config", f"{tmp_out}/config.json", "--out", f"{tmp_out}/out",
                  "--run-date", "2026-02-03", "--format", "parquet"])
    assert spark.read.parquet(paths.pop("rejected_lines")).count() == 0  # numbers as ids, amounts of 18 digits
    check_outputs({n: spark.read.parquet(p) for n, p in paths.items()}, OTHER)


def test_command_line_needs_its_settings(stored, tmp_out):
    from dealspark.__main__ import main

    with pytest.raises(SystemExit):
        main(["--ledger", stored[0], "--roster", stored[1], "--out", tmp_out])
    with open(f"{tmp_out}/config.json", "w") as f:
        json.dump({**settings(OTHER), "crosswalk": {}}, f)
    with pytest.raises(ValueError, match="crosswalk"):
        main(["--ledger", stored[0], "--roster", stored[1], "--config", f"{tmp_out}/config.json", "--out", tmp_out])


def test_command_line_over_fixture_tables(spark, tmp_out):
    from dealspark.__main__ import main

    paths = main(["--fixtures", SF_SMALL, "--out", tmp_out, "--run-date", "2026-02-03", "--format", "parquet",
                  "--begin", "2020-09-01", "--end", "2020-12-31", "--partition-deals-by-year"])
    years = sorted(d for d in os.listdir(paths["deal_data"]) if d.startswith("ending_year="))
    assert years and all(d.split("=")[1].isdigit() for d in years)
    back = spark.read.parquet(paths["deal_data"])
    con = duck(SF_SMALL)
    assert back.count() == len(con.execute(oracle.oracle_queries()["deal_data_late"]).fetchall())


def test_storing_splits_no_period_by_hand(spark, stored):
    periods = [d for d in os.listdir(stored[0]) if d.startswith("ending_period=")]
    files = sum(len([f for f in os.listdir(f"{stored[0]}/{d}") if f.startswith("part-")]) for d in periods)
    assert len(periods) > 50 and files < 2 * len(periods)  # small periods are one file each
    assert spark.read.parquet(stored[0]).count() == fixture_view_inputs(spark, SF_SMALL).ledger(None).count()


def test_a_cluster_without_a_shared_folder_fails():
    from dealspark.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
