"""What became of each batch, so that a run that died can be repeated without doubling a row.

A batch is *open* from its first write to its commit; its rows are stored under its id and readers leave them out.
A commit makes them visible at once in all tables, and notes the days that the batch touched. Derived tables owe these
days a rebuild until they are *settled*. Each note is one small file: ``open/``, ``done/`` and ``owed/`` below
``_ledger``, named by the batch. One writer at a time.
"""

import json
import re
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from skyledger.sources.folders import Folders

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


@dataclass(frozen=True)
class Note:
    """The clock of a batch and, once it is stored, the UTC days of its events and of its arrival."""

    clock: str
    event_days: list[str] = field(default_factory=list)
    arrival_days: list[str] = field(default_factory=list)


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.folders = Folders(spark)
        self.root = f"{root.rstrip('/')}/_ledger"

    def _path(self, kind: str, batch_id: str) -> str:
        return f"{self.root}/{kind}/{batch_id}.json"

    def _named(self, kind: str) -> list[str]:
        return [name.removesuffix(".json") for name in self.folders.names(f"{self.root}/{kind}") if name.endswith(".json") and name[0] != "_"]

    def _note(self, kind: str, batch_id: str) -> Note:
        return Note(**json.loads(self.folders.get(self._path(kind, batch_id))))

    def open_batches(self) -> list[str]:
        """Batches whose rows do not count (yet)."""
        return [batch for batch in self._named("open") if not self.is_done(batch)]

    def is_done(self, batch_id: str) -> bool:
        return self.folders.exists(self._path("done", batch_id))

    def begin(self, batch_id: str, as_of: str | None = None) -> tuple[Note | None, bool]:
        """(note, whether an earlier run of the batch died). The note is None if the batch is stored already.

        A repeated run goes by the clock of the first one, so that it writes the same rows to the same days.
        """
        if not _NAME.fullmatch(batch_id):
            raise ValueError(f"batch id {batch_id!r}: letters, digits, dots, dashes and underscores only")
        if self.is_done(batch_id):
            self.folders.remove(self._path("open", batch_id))
            return None, False
        if self.folders.exists(self._path("open", batch_id)):
            return self._note("open", batch_id), True
        note = Note(as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f"))
        self.folders.put(self._path("open", batch_id), json.dumps(asdict(note)))
        return note, False

    def commit(self, batch_id: str, note: Note) -> None:
        """From here on the batch counts. What it owes is written first: a batch never counts without it."""
        text = json.dumps(asdict(note))
        self.folders.put(self._path("owed", batch_id), text)
        self.folders.put(self._path("done", batch_id), text)
        self.folders.remove(self._path("open", batch_id))

    def owed(self) -> dict[str, Note]:
        """Committed batches whose days the derived tables still lack."""
        return {batch: self._note("owed", batch) for batch in self._named("owed") if self.is_done(batch)}

    def settle(self, batches: list[str]) -> None:
        for batch in batches:
            self.folders.remove(self._path("owed", batch))
