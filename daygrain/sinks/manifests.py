"""Numbered states of a folder of tables: the highest number is in force.

A state is published by creating the file of the next number, which only one of several writers
can do. The others see that they lost and start again from the winner's state, so none of two
publications is overwritten by the other.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

from daygrain.sinks import files

FOLDER = "_manifests"
_NAME = re.compile(r"(\d{10})\.json")


class Manifests:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, files.join(folder, FOLDER)

    def _path(self, number: int) -> str:
        return files.join(self.folder, f"{number:010d}.json")

    def numbers(self) -> list[int]:
        found = (_NAME.fullmatch(name) for name in files.children(self.spark, self.folder))
        return sorted(int(m[1]) for m in found if m)

    def read(self, number: int) -> dict | None:
        text = files.read_text(self.spark, self._path(number))
        return json.loads(text) if text else None

    def latest(self) -> tuple[int, dict | None]:
        """Number and content of the state in force; 0 and None before the first one."""
        while numbers := self.numbers():
            found = self.read(numbers[-1])
            if found is not None:  # else it was cleared away between the two calls
                return numbers[-1], found
        return 0, None

    def publish(self, number: int, state: dict) -> bool:
        """Put `state` in force as `number`; False if another writer has taken that number."""
        return files.create_text(self.spark, self._path(number), json.dumps(state))

    def forget(self, number: int) -> None:
        files.delete_folder(self.spark, self._path(number))
