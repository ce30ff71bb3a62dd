"""What a run of several steps has finished, kept where the next driver finds it."""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

from tableship.sources.resolve import exists


class Journal:
    """Outcomes of the steps of one run, each a small file that is written after its step.

    A run is known by its ``settings``: going on with it takes the same ones. A new run of the
    same settings starts an empty journal, so it never takes over outcomes of an older one.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: dict[str, Any]) -> None:
        self._spark = spark
        self._settings = json.dumps(settings, sort_keys=True)
        digest = hashlib.sha256(self._settings.encode()).hexdigest()[:32]
        self._folder = f"{folder.rstrip('/')}/{digest}"
        self._run = ""

    def start(self) -> None:
        self._run = uuid.uuid4().hex
        self._write("start", {"run": self._run, "settings": self._settings})

    def resume(self) -> bool:
        """Whether there is a run to go on with."""
        start = self._read("start")
        self._run = start["run"] if start else ""
        return bool(start)

    def outcome(self, step: str) -> dict[str, Any] | None:
        """What ``step`` has left, ``None`` where it has not ended."""
        return self._read(f"{self._run}/{step}")

    def done(self, step: str, **outcome: Any) -> None:
        self._write(f"{self._run}/{step}", outcome)

    def _write(self, name: str, content: dict[str, Any]) -> None:
        line = self._spark.createDataFrame([(json.dumps(content),)], "value string")
        line.coalesce(1).write.mode("overwrite").text(f"{self._folder}/{name}")

    def _read(self, name: str) -> dict[str, Any] | None:
        path = f"{self._folder}/{name}"
        lines = self._spark.read.text(path).collect() if exists(self._spark, path) else []
        # A driver lost while it wrote leaves a folder without the line.
        return json.loads(lines[0][0]) if lines else None
