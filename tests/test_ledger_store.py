"""The kept ledger: deliveries, late lines, failures between steps, pruning."""

import datetime as dt
import os
import re
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dealspark.functions.chart import Chart
from dealspark.operators.ledger import account_sums, by_grain, deal_ledger
from dealspark.plans.operations import incremental, split_ledger
from dealspark.session import FREE_SHUFFLES
from dealspark.sources import ledger_store as L
from dealspark.sources.extracts import fixture_view_inputs
from dealspark.sources.fixtures import MAIN

from .conftest import SF_SMALL
from .test_plans import plan_text


@pytest.fixture(scope="module")
def ledger(spark):
    return fixture_view_inputs(spark, SF_SMALL).ledger(None).cache()


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def expected(lines, cfg=MAIN):
    return rows(deal_ledger(lines.where(F.col("ending_period").between(cfg.begin, cfg.end)), cfg))


def kept(store, cfg=MAIN):
    from dealspark.operators.ledger import deal_measures
    return rows(deal_measures(store.account_sums((cfg.begin, cfg.end)), cfg.chart))


def test_late_lines_recompute_their_periods_only(spark, ledger, tmp_out):
    first, second = split_ledger(ledger)
    store = L.LedgerStore(spark, tmp_out, MAIN)
    all_periods = store.deliver(first, "day1")
    before = store._manifest()["sums"]
    assert kept(store) == expected(first)
    changed = store.deliver(second, "day2")
    after = store._manifest()["sums"]
    want = sorted(r[0].isoformat() for r in second.select("ending_period").distinct().collect())
    assert changed == want and 0 < len(want) < len(all_periods)
    assert any(p < "2020-10-01" for p in want)  # late lines
    assert {p for p in after if after[p] != before.get(p)} == set(want)
    assert kept(store) == expected(ledger)
    assert rows(store.lines()) == rows(ledger.select(*L.LEDGER_COLUMNS))


def test_untouched_periods_are_pruned(spark, ledger, tmp_out):
    first, second = split_ledger(ledger)
    store = L.LedgerStore(spark, tmp_out, MAIN)
    store.deliver(first, "day1")
    store.deliver(second, "day2")
    lines = store.changed_lines(store._manifest(), ["2020-03-31"])
    text = plan_text(lines)
    assert text.count("ReadSchema") == 2 == len(re.findall(r"PartitionFilters: \[.*ending_period.*2020-03-31", text))
    assert files_read(lines) == 2  # one of each delivery
    early = store.account_sums((dt.date(2019, 1, 1), dt.date(2019, 2, 28)))
    assert files_read(early) == 2  # one of each period


def made_lines(spark, n, hot=False):
    """Ledger lines of two periods from four tasks, two lines a deal, some
    deals without ids; ``hot``: all of one grain."""
    i = F.col("id")
    deal = F.lit(7).cast("bigint") if hot else F.when(F.floor(i / 2) % 50 != 0, F.floor(i / 2))
    values = {"deal_id": deal, "deal_line_id": deal, "team_id": F.lit("T1"), "market_region": F.lit(None).cast("string"),
              "close_date": F.lit(dt.date(2020, 3, 2)), "final_close_price": F.lit(5).cast("decimal(18,2)"),
              "ending_period": F.when((F.floor(i / 2) % 3 == 0) & F.lit(not hot), F.lit(dt.date(2020, 4, 30))).otherwise(F.lit(dt.date(2020, 3, 31))),
              "account_number": F.when(i % 2 == 0, F.lit("400001")).otherwise(F.lit("502001")),
              "amount": F.when(i % 9 != 0, (i % 1000).cast("decimal(18,2)"))}
    return spark.range(0, n, 1, 4).select(*[values.get(c, F.lit("x")).alias(c) for c in L.LEDGER_COLUMNS])


@pytest.fixture()
def small_pieces(spark):
    """Settings under which a scan packs all it finds, and pieces are small."""
    settings = {"spark.sql.files.minPartitionNum": "1", "spark.sql.files.openCostInBytes": "0",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sums_take_lines_in_pieces_whatever_the_scan_packs(spark, tmp_out, monkeypatch, small_pieces):
    """A task's partial sums hold a row for each grain of the lines it reads."""
    lines, seen, real = made_lines(spark, 20000), [], L.account_sums
    monkeypatch.setattr(L, "account_sums", lambda lines, cfg: seen.append(lines) or real(lines, cfg))
    store = L.LedgerStore(spark, tmp_out, MAIN)
    store.deliver(lines, "all")
    assert len(dealt(store.lines())) == 1  # one task scans all of it
    parts = dealt(seen[0])
    assert sum(parts) == 20000 and max(parts) <= 10000
    assert kept(store) == expected(lines)


def test_a_grain_of_very_many_lines_is_cut(spark, small_pieces):
    """Its lines, sent by several tasks, do not all land in one."""
    lines = made_lines(spark, 100000, hot=True)
    parts = dealt(by_grain(lines))
    assert sum(parts) == 100000 and max(parts) <= 50000
    assert rows(account_sums(by_grain(lines), MAIN)) == rows(account_sums(lines, MAIN))


def dealt(df):
    """Rows of each partition of a frame that has some."""
    at = df.select(*df.columns, F.spark_partition_id().alias("__at")).localCheckpoint()
    return [r["count"] for r in at.groupBy("__at").count().collect()]


def files_read(df):
    """Files that the scans of a frame opened, by their metrics."""
    df.collect()
    found, queue = 0, [df._jdf.queryExecution().executedPlan()]
    while queue:
        node = queue.pop()
        if node.nodeName().startswith("Scan"):
            found += node.metrics().apply("numFiles").value()
        children = node.children()
        queue += [children.apply(i) for i in range(children.size())]
    return found


def test_a_delivery_again_replaces_its_lines(spark, ledger, tmp_out):
    first, second = split_ledger(ledger)
    store = L.LedgerStore(spark, tmp_out, MAIN)
    store.deliver(first, "day1")
    store.deliver(second, "day2")
    store.deliver(second, "day2")
    assert kept(store) == expected(ledger)
    fewer = second.where("ending_period >= DATE '2020-11-01'")
    changed = store.deliver(fewer, "day2")  # periods that lost their late lines are recomputed
    assert any(p < "2020-10-01" for p in changed)
    assert kept(store) == expected(first.unionByName(fewer))


@pytest.mark.parametrize("broken", ["lines", "sums"])
def test_a_delivery_that_breaks_is_finished_later(spark, ledger, tmp_out, monkeypatch, broken):
    first, second = split_ledger(ledger)
    store = L.LedgerStore(spark, tmp_out, MAIN)
    store.deliver(first, "day1")
    if broken == "lines":
        bad = second.withColumn("item_name", F.when(F.col("item_id") != "799", F.col("item_name")).otherwise(F.raise_error(F.lit("broken"))))
        with pytest.raises(Exception, match="broken"):
            store.deliver(bad, "day2")
        assert kept(store) == expected(first)
        store.deliver(second, "day2")
    else:
        def fails(*a):
            raise RuntimeError("broken")
        with monkeypatch.context() as m:
            m.setattr(L, "account_sums", fails)
            with pytest.raises(RuntimeError, match="broken"):
                store.deliver(second, "day2")
        assert store._manifest()["open"]
    assert kept(L.LedgerStore(spark, tmp_out, MAIN)) == expected(ledger)
    assert not store._manifest()["open"]


def test_sums_of_another_configuration_are_recomputed(spark, ledger, tmp_out):
    L.LedgerStore(spark, tmp_out, MAIN).deliver(ledger, "all")
    for other in (replace(MAIN, split_region="EUROPE"),
                  replace(MAIN, chart=Chart(("400001", "502001", "439901"), (("total_gci", ("400001", "439901")), ("total_referral", ()),
                                                                           ("commission_expense", ("502001",)), ("aep", ())), "439901"))):
        assert kept(L.LedgerStore(spark, tmp_out, other), other) == expected(ledger, other)
    assert kept(L.LedgerStore(spark, tmp_out, MAIN)) == expected(ledger)


def test_empty_deliveries_and_missing_periods(spark, ledger, tmp_out):
    store = L.LedgerStore(spark, tmp_out, MAIN)
    assert store.deliver(ledger.limit(0), "nothing") == []
    assert kept(store) == []
    with pytest.raises(ValueError, match="no delivery"):
        L.LedgerStore(spark, f"{tmp_out}/none", MAIN).lines()
    some = ledger.where("ending_period = DATE '2020-03-31'").limit(5)
    nowhere = some.withColumn("ending_period", F.lit(None).cast("date"))
    assert store.deliver(some.unionByName(nowhere), "some") == ["2020-03-31"]
    assert store.lines().count() == some.count() + nowhere.count()
    assert kept(store) == expected(store.lines())
    assert os.path.isdir(tmp_out)


def shuffle_files(spark):
    """Shuffle files on this session's disks."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that came and stay; they are removed in the background."""
    for _ in range(50):
        if not (more := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return more


def uncached(spark):
    """The ledger as a plan of its own, that finds nothing in the cache."""
    return fixture_view_inputs(spark, SF_SMALL).ledger((dt.date(2010, 1, 1), dt.date(2030, 12, 31)))


def test_deliveries_leave_no_shuffle_files(spark, tmp_out):
    """Else they stay until the driver collects garbage: those of every step lie on disk together."""
    before, was = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    store = L.LedgerStore(spark, tmp_out, MAIN)
    for name, lines in zip(("day1", "day2"), split_ledger(uncached(spark))):
        store.deliver(lines, name)
    assert not left(spark, before)
    assert spark.conf.get(FREE_SHUFFLES, None) == was


def test_the_roster_join_reads_stored_deal_rows(spark):
    """So that the shuffles of the AEP merge do not lie on disk with its own."""
    assert all("/tables/" in f for f in incremental("deal_data")(spark, SF_SMALL).inputFiles())


def test_lines_and_sums_go_some_periods_at_a_time(spark, tmp_out, monkeypatch):
    """So that the shuffles on disk are those of a part; whole periods, each once."""
    monkeypatch.setattr(L, "LEAST_PIECE", 1)
    month = F.last_day(F.add_months(F.lit(dt.date(2018, 11, 1)), (F.col("__n") % 26).cast("int")))
    lines = made_lines(spark, 4000).withColumn("__n", F.floor(F.coalesce(F.col("deal_id"), F.lit(0)) / 3))
    lines = lines.withColumn("ending_period", F.when(F.col("__n") % 27 != 26, month)).drop("__n")
    seen, laid, real, pieces = [], [], L.account_sums, L.in_pieces
    monkeypatch.setattr(L, "account_sums", lambda lines, cfg: seen.append(lines) or real(lines, cfg))
    monkeypatch.setattr(L, "in_pieces", lambda sizes: laid.append((sizes, pieces(sizes))) or laid[-1][1])
    store = L.LedgerStore(spark, tmp_out, MAIN)
    periods = store.deliver(lines, "all")
    staged, summed = laid
    assert len(staged[1]) >= 6 and len(summed[1]) >= 6 and len(periods) == 26
    for sizes, found in laid:
        assert [n for some in found for n in some] == sorted(sizes)
        assert all(len(some) == 1 or sum(sizes[n] for n in some) <= sum(sizes.values()) // L.PIECES for some in found)
    of_each = [{r[0].isoformat() for r in some.select("ending_period").distinct().collect()} for some in seen]
    assert of_each == [set(some) for some in summed[1]]
    assert rows(store.lines()) == rows(lines)
    assert kept(store) == expected(lines)
    assert not L.files.listed(spark, f"{tmp_out}/staged")


def test_pieces():
    mb = 1 << 20
    assert L.in_pieces({}) == []
    assert L.in_pieces({"b": 10 * mb, "a": 1, "c": 7 * mb}) == [["a", "b"], ["c"]]  # not less than 16 MB
    assert L.in_pieces({f"{k:02d}": 100 * mb for k in range(16)}) == [[f"{k:02d}", f"{k + 1:02d}"] for k in range(0, 16, 2)]
    assert L.in_pieces({"a": 1, "b": 900 * mb, "c": 1, "d": 1}) == [["a"], ["b"], ["c", "d"]]


def test_staged_lines_of_a_broken_delivery_are_removed(spark, ledger, tmp_out, monkeypatch):
    store = L.LedgerStore(spark, tmp_out, MAIN)

    def fails(sizes):
        assert L.files.listed(spark, f"{tmp_out}/staged")
        raise RuntimeError("broken")
    with monkeypatch.context() as m:
        m.setattr(L, "in_pieces", fails)
        with pytest.raises(RuntimeError, match="broken"):
            store.deliver(ledger, "day1")
    assert not L.files.listed(spark, f"{tmp_out}/staged")
    assert store.deliver(ledger, "day1") and kept(store) == expected(ledger)


def test_late_lines_are_picked_before_the_join(spark):
    """What the split asks of an order's period reaches the orders' side; lines without a period are first ones."""
    second = split_ledger(uncached(spark))[1]
    assert re.search(r"Filter .*month\(.*\n[^\n]*Scan parquet .*o_orderdate", second._jdf.queryExecution().executedPlan().toString())
    i = spark.range(4).withColumn("ending_period", F.when(F.col("id") == 1, F.lit(dt.date(2020, 11, 30))).when(F.col("id") > 1, F.lit(dt.date(2020, 3, 31))))
    i = i.withColumn("item_id", F.when(F.col("id") == 2, F.lit("799")))
    assert [sorted(r[0] for r in part.select("id").collect()) for part in split_ledger(i)] == [[0, 3], [1, 2]]
