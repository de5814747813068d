"""A stage store: a rerun goes on after the last stage that was finished.

Stages lie under ``<root>/<key>``, the key being a digest of the configuration,
of the version of the inputs and of the package, so another configuration or
changed inputs start anew.  A stage is written into a folder of its own and
counts as finished when its small manifest is in place, which is one step; a
run that breaks leaves no half stage that a rerun could read.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import __version__
from ..config import ReportConfig
from ..sources import files


class StageStore:
    def __init__(self, spark: SparkSession, root: str, cfg: ReportConfig, version: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.key = hashlib.sha256(repr((cfg, version, __version__)).encode()).hexdigest()[:32]

    def _manifest(self, stage: str) -> str:
        return f"{self.root}/{self.key}/{stage}.json"

    def finished(self, stage: str) -> bool:
        return files.exists(self.spark, self._manifest(stage))

    def get(self, stage: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored stage; built and stored first if it is not finished."""
        if not self.finished(stage):
            folder = f"{self.key}/{stage}-{uuid.uuid4().hex}"
            build().write.parquet(f"{self.root}/{folder}")
            files.replace_text(self.spark, self._manifest(stage), json.dumps({"folder": folder}))
        folder = json.loads(files.read_text(self.spark, self._manifest(stage)))["folder"]
        return self.spark.read.parquet(f"{self.root}/{folder}")

    def remove_old(self, older_than_hours: float) -> list[str]:
        """Remove the stages of other keys that have not changed for so long;
        the removed keys."""
        gone = []
        for entry in files.listed(self.spark, self.root):
            changed = max([entry.changed, *[e.changed for e in files.listed(self.spark, entry.path)]]) if entry.is_folder else 0
            if entry.is_folder and entry.name != self.key and time.time() - changed > older_than_hours * 3600:
                files.remove(self.spark, entry.path)
                gone.append(entry.name)
        return gone
