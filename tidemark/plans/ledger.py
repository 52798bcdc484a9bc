"""What each stage of a run still has to do, kept until it is done."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemark.session import file_names, read_file, remove, write_file


@dataclass(frozen=True)
class Due:
    """Slices that a stage is to bring up to date, and the notes that say so."""

    slices: tuple[str, ...] = ()
    notes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ledger:
    """Notes, a small file each, by stage.

    A stage notes what follows from its change before the change can no longer be seen again,
    and takes its own notes away after the change is in place. So a run that breaks off
    anywhere leaves notes, and the next one, for whatever day, does what they say; to do a
    slice twice is to do it once. A note holds the slices that one batch touched.
    """

    spark: SparkSession
    path: str

    def note(self, stage: str, slices: Iterable[str], name: str | None = None) -> None:
        """Notes of one ``name`` are one note."""
        wanted = sorted(set(slices))
        if wanted:
            write_file(self.spark, f"{self.path}/{stage}/{name or uuid.uuid4().hex}", json.dumps(wanted))

    def due(self, stage: str) -> Due:
        notes = [n for n in file_names(self.spark, f"{self.path}/{stage}") if not n.startswith((".", "_"))]
        told = (json.loads(read_file(self.spark, f"{self.path}/{stage}/{n}")) for n in notes)
        return Due(tuple(sorted({s for slices in told for s in slices})), tuple(notes))

    def done(self, stage: str, due: Due) -> None:
        for note in due.notes:
            remove(self.spark, f"{self.path}/{stage}/{note}")
