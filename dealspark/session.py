"""Session defaults and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings every job here relies on; cluster launchers may pass their own.
SESSION_DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide aggregations (36 sums, 71-column outputs) stay inside codegen.
    "spark.sql.codegen.maxFields": "400",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, app: str = "dealspark") -> SparkSession:
    """Local session for tests and the benchmark (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DEALSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        # Small local inputs: let adaptive coalescing keep one task per core even
        # where a join fans rows out after a small shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="dealspark-wh-"))
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the session defaults on an existing session where they are unset."""
    for k, v in SESSION_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder named by the cluster (``spark.checkpoint.dir``).  A
    local master without one gets a fresh temporary folder; any other fails,
    since executors would write to disks that nobody else sees."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="dealspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df, name: str):
    """Cut lineage by writing ``df`` once as a Parquet table in the cluster's
    checkpoint folder and reading it back.  Unlike ``Dataset.checkpoint`` this
    computes the frame once, stores it compressed and columnar, and later
    readers get column pruning and filter pushdown on it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold for what is planned inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_freed(spark: SparkSession):
    """What is written inside removes its shuffle files when it ends (Spark 4.1
    on; earlier versions ignore the setting).  Otherwise they stay on the
    executors' disks until the driver happens to collect its garbage, so that
    a job of several writes holds the shuffles of all of them."""
    return settings(spark, {FREE_SHUFFLES: "true"})


@dataclass(frozen=True)
class Measured:
    """A stored frame with its rows and their decoded size, both counted while
    it was stored."""

    frame: DataFrame
    rows: int
    bytes: int


def decoded_bytes(schema: T.StructType) -> Column:
    """Size of a row in memory, as Spark's rows lay it out: eight bytes a
    field, a bit for each NULL, and what does not fit into eight bytes behind
    (texts by their length; nested values by their JSON)."""
    size = F.lit(8 * (len(schema) + -(-len(schema) // 64)))
    for f in schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            length = F.octet_length(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            length = F.octet_length(F.to_json(F.struct(c)))
        elif isinstance(f.dataType, T.DecimalType) and f.dataType.precision > 18:
            length = F.lit(16)
        else:
            continue
        size = size + F.coalesce(F.ceil(length / 8) * 8, F.lit(0))
    return size.cast("bigint")


def materialize_measured(df, name: str) -> Measured:
    """``materialize`` that counts rows and decoded bytes while it writes: the
    files alone do not tell, as dictionaries and compression may shrink a
    column many times."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(decoded_bytes(df.schema)).alias("bytes"))
    frame = materialize(observed, name)
    return Measured(frame, seen.get["rows"], seen.get["bytes"] or 0)
