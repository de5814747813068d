"""Output sinks (K1-K5): three outputs published together.

A run writes each output into a folder of its own,
``<base>/<name>/run_date=YYYY-MM-DD/run=<run>``, and counts its rows while it
writes.  When all three are written, one small manifest,
``<base>/manifests/YYYY-MM-DD.json``, is replaced: it names the run's folders,
rows and schemas.  Readers go by the manifest (``read_outputs``), so they see
all three outputs of one run or all three of the run before, whatever fails;
a rerun on the same day replaces that day's manifest, earlier days stay.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cohorts import GROUP
from ..operators.principals import INDEX
from . import files

OUTPUT_NAMES = ("deal_data", "principal_data", "principal_mix_data")
REJECTED = "rejected_lines"
# Columns that carry the label for NULL: the keys of the two summaries.  The
# deal output and all measures keep NULL.
LABELLED = {"principal_data": INDEX, "principal_mix_data": GROUP}
MANIFESTS = "manifests"


def run_path(base: str, name: str, run_date: dt.date, run: str) -> str:
    return f"{base.rstrip('/')}/{name}/run_date={run_date.isoformat()}/run={run}"


def manifest_path(base: str, run_date: dt.date) -> str:
    return f"{base.rstrip('/')}/{MANIFESTS}/{run_date.isoformat()}.json"


def labelled(df: DataFrame, label: str, columns: tuple[str, ...]) -> DataFrame:
    """``df`` with ``label`` for NULL in the named columns, as text."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(label)).alias(c) if c in columns else F.col(c) for c in df.columns])


def write_frame(df: DataFrame, path: str, fmt: str = "csv", null_label: str | None = None, labelled_columns: tuple[str, ...] = (),
                partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write part files by the executors; the frame as written is returned."""
    if fmt == "csv" and null_label is not None:
        df = labelled(df, null_label, labelled_columns)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("dateFormat", "yyyy-MM-dd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return df


def write_outputs(outputs: dict[str, DataFrame], base: str, run_date: dt.date, fmt: str = "csv",
                  null_label: str | None = None, partition_by: dict[str, tuple[str, ...]] | None = None) -> dict[str, str]:
    """Write the outputs, and what else is given (``rejected_lines``), and
    publish them together; their folders."""
    spark, run, written = next(iter(outputs.values())).sparkSession, uuid.uuid4().hex, {}
    for name in (*OUTPUT_NAMES, *sorted(set(outputs) - set(OUTPUT_NAMES))):
        path, counted = run_path(base, name, run_date, run), Observation(f"rows-{name}-{run}")
        df = outputs[name].observe(counted, F.count(F.lit(1)).alias("rows"))
        df = write_frame(df, path, fmt, null_label, LABELLED.get(name, ()), (partition_by or {}).get(name, ()))
        written[name] = {"path": path[len(base.rstrip("/")) + 1:], "rows": counted.get["rows"], "schema": df.schema.jsonValue()}
    manifest = {"run_date": run_date.isoformat(), "run": run, "format": fmt, "outputs": written}
    files.replace_text(spark, manifest_path(base, run_date), json.dumps(manifest, indent=1))
    return {name: f"{base.rstrip('/')}/{o['path']}" for name, o in written.items()}


def read_manifest(spark: SparkSession, base: str, run_date: dt.date | None = None) -> dict:
    """The manifest of a day, by default of the last one published."""
    if run_date is None:
        days = [e.name for e in files.listed(spark, f"{base.rstrip('/')}/{MANIFESTS}") if e.name.endswith(".json")]
        if not days:
            raise FileNotFoundError(f"nothing is published under {base}")
        run_date = dt.date.fromisoformat(days[-1].removesuffix(".json"))
    return json.loads(files.read_text(spark, manifest_path(base, run_date)))


def read_outputs(spark: SparkSession, base: str, run_date: dt.date | None = None) -> dict[str, DataFrame]:
    """The published outputs of a day, by default of the last one, with the
    column types they were written with."""
    manifest = read_manifest(spark, base, run_date)
    reader = spark.read.format(manifest["format"])
    if manifest["format"] == "csv":
        reader = reader.option("header", True).option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST")
    return {name: reader.schema(T.StructType.fromJson(o["schema"])).load(f"{base.rstrip('/')}/{o['path']}")
            for name, o in manifest["outputs"].items()}


def remove_unpublished(spark: SparkSession, base: str, older_than_hours: float) -> list[str]:
    """Remove folders of runs that no manifest names and that are older than
    given (a run that is still writing is younger); the removed folders."""
    root, gone = base.rstrip("/"), []
    named = {read_manifest(spark, base, dt.date.fromisoformat(e.name.removesuffix(".json")))["run"]
             for e in files.listed(spark, f"{root}/{MANIFESTS}") if e.name.endswith(".json")}
    for name in (*OUTPUT_NAMES, REJECTED):
        for day in files.listed(spark, f"{root}/{name}"):
            for run in files.listed(spark, day.path):
                if run.name.removeprefix("run=") not in named and time.time() - run.changed > older_than_hours * 3600:
                    files.remove(spark, run.path)
                    gone.append(run.path)
    return gone
