"""A ledger kept in deliveries, and its deal sums kept by period.

Daily runs need not read the whole ledger again.  A delivery of lines is stored
partitioned by ``ending_period``; the sums at the deal grain are kept for each
period, and a delivery recomputes the periods it has lines for and no other:
late lines of an old period cost that period.  The deal ledger of a window is
read from the kept sums of its periods.

One small manifest, replaced in one step, names the folder of every delivery
and of every period's sums.  A delivery goes

1. lines into a folder of their own,
2. manifest: the delivery, and its periods as ``open``,
3. sums of the open periods into a folder of their own,
4. manifest: the sums of these periods, nothing open.

Whatever breaks between two steps leaves the old state or open periods, which
the next delivery or reader closes; delivering the same name again replaces
its lines (periods they no longer have are recomputed too).  Sums of another
configuration (split region, chart) are all recomputed.  One writer at a time.

Lines without a period belong to no window: they are stored and summed nowhere.

Disk: a delivery's lines are first stored as they come (``staged``), which ends
the source's own shuffles, and both the lines' layout by period and the sums go
some periods at a time (``in_pieces``); each write removes its shuffle files.
So the shuffles that lie on disk at a time are the source's own, or those of
about an eighth of the lines, or of a period with more.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ReportConfig
from ..operators.ledger import account_sums, by_grain
from ..session import settings, shuffles_freed
from . import files
from .extracts import LEDGER_COLUMNS, STORED_ORDER, Inputs, Window, checked_ledger

MANIFEST = "ledger.json"
# Staged lines lie in as many folders, each of whole months; a task writes to all of them at once, in row groups of so
# many bytes, so that it need not sort its lines.
STAGED_BY, STAGED_FOLDERS, STAGED_BLOCK = "__folder", 16, 8 << 20
# Stored bytes handled at a time: this share of all, and not less than the second.
PIECES, LEAST_PIECE = 8, 16 << 20


class LedgerStore:
    def __init__(self, spark: SparkSession, root: str, cfg: ReportConfig):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg

    # --- manifest --------------------------------------------------------------

    @property
    def _sums_key(self) -> str:
        return hashlib.sha256(repr((self.cfg.split_region, self.cfg.chart)).encode()).hexdigest()[:16]

    def _manifest(self) -> dict:
        path = f"{self.root}/{MANIFEST}"
        found = json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else {"deliveries": {}, "sums": {}, "open": [], "key": self._sums_key}
        if found["key"] != self._sums_key:  # sums of another configuration
            found.update(sums={}, open=sorted({p for d in found["deliveries"].values() for p in d["periods"]}), key=self._sums_key)
        return found

    def _replace(self, manifest: dict) -> None:
        files.replace_text(self.spark, f"{self.root}/{MANIFEST}", json.dumps(manifest, indent=1))

    # --- deliveries ------------------------------------------------------------

    def deliver(self, lines: DataFrame, name: str) -> list[str]:
        """Store the lines of a delivery and recompute the sums of its periods;
        the recomputed periods."""
        folder = f"lines/{name}-{uuid.uuid4().hex}"
        rows = checked_ledger(lines)
        self._store(rows, f"{self.root}/{folder}")
        manifest = self._manifest()
        # One row for each period: as many as the calendar has months.
        periods = [e.name.partition("=")[2] for e in files.listed(self.spark, f"{self.root}/{folder}") if e.is_folder and "=" in e.name]
        periods = sorted(p for p in periods if _is_date(p))
        before = manifest["deliveries"].get(name, {}).get("periods", [])
        manifest["deliveries"][name] = {"folder": folder, "periods": periods, "schema": rows.schema.jsonValue()}
        manifest["open"] = sorted({*manifest["open"], *periods, *before})
        self._replace(manifest)
        return self.close_open()

    def _store(self, rows: DataFrame, folder: str) -> None:
        """Lines partitioned by period.  A source may be joined and shuffled
        itself: its rows are staged, so that its shuffles are gone when the
        lines are dealt by period."""
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        month = F.year("ending_period") * 12 + F.month("ending_period")
        out = rows.withColumn(STAGED_BY, F.coalesce(F.pmod(month, F.lit(STAGED_FOLDERS)), F.lit(0)))
        try:
            with shuffles_freed(self.spark), settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": str(STAGED_FOLDERS)}):
                out.write.option("parquet.block.size", STAGED_BLOCK).partitionBy(STAGED_BY).parquet(staged)
            found = {e.path: files.size(self.spark, e.path) for e in files.listed(self.spark, staged) if e.is_folder}
            for paths in in_pieces(found) or [[staged]]:  # without lines: an empty folder
                some = self.spark.read.schema(rows.schema).parquet(*paths)
                # A period's files are sorted by account and item, so that their statistics rule pages out.
                some = some.hint("rebalance", "ending_period").sortWithinPartitions(*STORED_ORDER)
                with shuffles_freed(self.spark):
                    some.write.mode("append").partitionBy("ending_period").parquet(folder)
        finally:
            files.remove(self.spark, staged)

    def close_open(self) -> list[str]:
        """Recompute the sums of the open periods."""
        manifest = self._manifest()
        open_ = manifest["open"]
        if open_:
            manifest["sums"] = {p: f for p, f in manifest["sums"].items() if p not in open_}
            folder = f"sums/{uuid.uuid4().hex}"
            for some in in_pieces(self._bytes(manifest, open_)):
                sums = account_sums(by_grain(self.changed_lines(manifest, some)), self.cfg).hint("rebalance", "ending_period")
                with shuffles_freed(self.spark):
                    sums.write.mode("append").partitionBy("ending_period").parquet(f"{self.root}/{folder}")
            for e in files.listed(self.spark, f"{self.root}/{folder}"):
                if e.is_folder:
                    manifest["sums"][e.name.partition("=")[2]] = folder
            manifest["open"] = []
            self._replace(manifest)
        return open_

    def _bytes(self, manifest: dict, periods: list[str]) -> dict[str, int]:
        """Stored bytes of the lines of the given periods that have some."""
        found: dict[str, int] = {}
        for d in manifest["deliveries"].values():
            for p in sorted({*d["periods"]} & {*periods}):
                found[p] = found.get(p, 0) + files.size(self.spark, f"{self.root}/{d['folder']}/ending_period={p}")
        return found

    def changed_lines(self, manifest: dict, periods: list[str]) -> DataFrame | None:
        """The lines of the given periods: only deliveries that have some, and
        of these only the periods' partitions."""
        parts = [d for d in manifest["deliveries"].values() if set(d["periods"]) & set(periods)]
        return self._lines(parts).where(F.col("ending_period").isin([dt.date.fromisoformat(p) for p in periods])) if parts else None

    def _lines(self, deliveries: list[dict]) -> DataFrame:
        out = None
        for d in deliveries:  # with its schema: a delivery may be empty
            part = self.spark.read.schema(T.StructType.fromJson(d["schema"])).parquet(f"{self.root}/{d['folder']}").select(*LEDGER_COLUMNS)
            out = part if out is None else out.unionByName(part)
        return out

    # --- reading ---------------------------------------------------------------

    def lines(self, window: Window | None = None) -> DataFrame:
        """The ledger lines of all deliveries, of a window's periods."""
        deliveries = list(self._manifest()["deliveries"].values())
        if not deliveries:
            raise ValueError(f"no delivery is stored under {self.root}")
        if window is None:
            return self._lines(deliveries)
        lines = self._lines([d for d in deliveries if any(_within(p, window) for p in d["periods"])] or deliveries[:1])
        return lines.where(F.col("ending_period").between(F.lit(window[0]), F.lit(window[1])))

    def account_sums(self, window: Window) -> DataFrame:
        """The kept sums of the window's periods."""
        self.close_open()
        kept = self._manifest()["sums"]
        periods: dict[str, list[str]] = {}
        for period, folder in kept.items():
            if _within(period, window):
                periods.setdefault(folder, []).append(period)
        if not periods:
            return account_sums(by_grain(self.lines(window)), self.cfg)
        out = None
        for folder, some in sorted(periods.items()):
            part = self.spark.read.parquet(f"{self.root}/{folder}").withColumn("ending_period", F.col("ending_period").cast("date"))
            part = part.where(F.col("ending_period").isin([dt.date.fromisoformat(p) for p in some]))
            out = part if out is None else out.unionByName(part)
        return out

    def inputs(self, roster: DataFrame, roster_version: str | None = None) -> Inputs:
        """The job's inputs, the deal ledger from the kept sums.  With a
        version of the roster they have one themselves, so that stages can be
        kept over them."""
        version = None if roster_version is None else lambda: self.version(roster_version)
        return Inputs(ledger=self.lines, roster=roster, account_sums=self.account_sums, version=version)

    def version(self, roster_version: str) -> str:
        """A digest of the deliveries and the roster's version."""
        return hashlib.sha256(json.dumps([self._manifest()["deliveries"], roster_version], sort_keys=True).encode()).hexdigest()


def in_pieces(sizes: dict[str, int]) -> list[list[str]]:
    """Names in their order, as many together as hold an eighth of all bytes."""
    most, out, held = max(LEAST_PIECE, sum(sizes.values()) // PIECES), [], 0
    for name in sorted(sizes):
        if out and held + sizes[name] <= most:
            out[-1].append(name)
        else:
            out.append([name])
            held = 0
        held += sizes[name]
    return out


def _is_date(text: str) -> bool:
    try:
        dt.date.fromisoformat(text)
    except ValueError:
        return False
    return True


def _within(period: str, window: Window) -> bool:
    return window[0] <= dt.date.fromisoformat(period) <= window[1]
