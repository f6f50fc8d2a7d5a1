"""A table's commit log: what was done to it, one numbered note per step.

A step's files are written first, under names of their own; the step counts
once its note stands. A note says all that the next step must know (totals,
numbers given out, folders that make up the table), so a step reads one note,
however long the log and however large the table.

One writer at a time may extend a log. The file system must rename atomically.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from shelfmark.sources import folders

HINT = "latest"


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _note(self, commit: int) -> str:
        return f"{self.path}/{commit:020d}.json"

    def latest(self) -> dict[str, Any] | None:
        """The last note, with its number as ``commit``; None if nothing was done yet.

        The hint names the last step or one shortly before it, so that the log is
        not listed.
        """
        hint = folders.read_note(self.spark, f"{self.path}/{HINT}")
        commit = int(hint) if hint else 0
        while folders.exists(self.spark, self._note(commit + 1)):
            commit += 1
        return self.note(commit)

    def note(self, commit: int) -> dict[str, Any] | None:
        """The note of a step, or None if there is no such step."""
        text = folders.read_note(self.spark, self._note(commit))
        return None if text is None else json.loads(text)

    def append(self, after: dict[str, Any] | None, facts: dict[str, Any]) -> dict[str, Any]:
        """Adds a note behind ``after``, the last one its writer has seen."""
        commit = 1 if after is None else after["commit"] + 1
        if folders.exists(self.spark, self._note(commit)):
            raise RuntimeError(f"{self.path} was extended by another writer")
        note = {**facts, "commit": commit}
        folders.write_note(self.spark, self._note(commit), json.dumps(note))
        folders.write_note(self.spark, f"{self.path}/{HINT}", str(commit))
        return note

    def notes(self, schema: str) -> DataFrame | None:
        """All notes as rows; None if there are none."""
        if self.latest() is None:
            return None
        return self.spark.read.schema(f"commit long, {schema}").json(f"{self.path}/*.json")
