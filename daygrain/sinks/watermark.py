"""How far each table has come: the last day whose two writes both succeeded."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrain.sinks import files


class Watermarks:
    """One small state file per table on the lake's own file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, table: str) -> str:
        return files.join(self.folder, f"{table}.json")

    def get(self, table: str) -> str | None:
        text = files.read_text(self.spark, self._path(table))
        return json.loads(text)["dt"] if text else None

    def put(self, table: str, dt: str) -> None:
        files.replace_text(self.spark, self._path(table), json.dumps({"dt": dt}))


def advance(store, table: str, dt: str) -> bool:
    """Move forward only: re-running an old day leaves the mark. ISO days compare as text."""
    current = store.get(table)
    if current is not None and current >= dt:
        return False
    store.put(table, dt)
    return True


def latest(log: DataFrame) -> DataFrame:
    """The same state from a log of finished (table, dt) runs."""
    return log.groupBy("table").agg(F.max("dt").alias("dt"))
