"""Runs that are published at once, and taken up again after a failure.

Every run writes into a folder of its own. One small file, replaced last, names the tables of the published run; a
reader resolves it once and keeps reading these folders, whatever builds run or break meanwhile. A table that a run
has finished is noted under the fingerprint of what it was made from, so that a later run on the same inputs, a retry
or a run in which only one feed has changed, takes it over and does not compute it again.

A table that only grows (the key registry) is a list of versions. The next version is taken by creating a file that
must not exist; a run that comes second reads again and builds its rows anew, so two runs never hand out one id twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reportstar.sinks.files import SmallFiles
from reportstar.sinks.store import shuffles_freed

POINTER = "published.json"
SCRATCH, GROWN = "scratch_", "grown"


@dataclass(frozen=True)
class Stored:
    """Folders below the root that together are a table."""

    folders: tuple[str, ...]
    schema: str

    def note(self) -> dict:
        return {"folders": list(self.folders), "schema": self.schema}

    @classmethod
    def of(cls, note: dict) -> Stored:
        return cls(tuple(note["folders"]), note["schema"])


class RunStore:
    """The tables of one run under `root`. `RunStore(spark, root)` begins a run; `RunStore.published` is the one to read."""

    #: Finished tables are noted and taken over by later runs.
    resumes = True

    def __init__(self, spark: SparkSession, root: str, run: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = SmallFiles(spark, self.root)
        self.run = run or uuid.uuid4().hex
        self.tables: dict[str, Stored] = {}
        self.notes: dict[str, dict[str, int | None] | None] = {}
        if run is None:
            self.files.replace(f"runs/{self.run}.json", json.dumps({"started": _now().isoformat()}))

    @classmethod
    def published(cls, spark: SparkSession, root: str) -> RunStore:
        text = SmallFiles(spark, root).read(POINTER)
        if text is None:
            raise LookupError(f"no run has been published under {root}")
        known = json.loads(text)
        store = cls(spark, root, known["run"])
        store.tables = {name: Stored.of(note) for name, note in known["tables"].items()}
        return store

    def last_published(self) -> RunStore:
        return RunStore.published(self.spark, self.root)

    def _load(self, stored: Stored) -> DataFrame:
        schema = StructType.fromJson(json.loads(stored.schema))
        reader = self.spark.read.schema(schema)
        if stored.folders[0].startswith(GROWN):  # versions side by side are partitions of one table
            reader = reader.option("basePath", f"{self.root}/{stored.folders[0].rpartition('/')[0]}")
        return reader.parquet(*[f"{self.root}/{f}" for f in stored.folders]).select(schema.names)

    def read(self, name: str) -> DataFrame:
        return self._load(self.tables[name])

    def read_if_exists(self, name: str) -> DataFrame | None:
        return self.read(name) if name in self.tables else None

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        folder = f"runs/{self.run}/{name}"
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.root}/{folder}")
        self.tables[name] = Stored((folder,), df.schema.json())
        return self.read(name)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        return self.extend(name, lambda _: df, partition_by)

    def extend(
        self, name: str, build: Callable[[DataFrame | None], DataFrame], partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Add the rows that `build` makes from the table so far. It is called again if another run was first."""
        while True:
            taken = self.files.names(f"versions/{name}")
            notes = [Stored.of(json.loads(self.files.read(f"versions/{name}/{v}"))) for v in taken]
            folders = tuple(f for n in notes for f in n.folders)
            existing = self._load(Stored(folders, notes[0].schema)) if notes else None
            rows = build(existing)
            folder = f"{GROWN}/{name}/version_id={uuid.uuid4().hex}"
            with shuffles_freed(self.spark):
                rows.write.partitionBy(*partition_by).parquet(f"{self.root}/{folder}")
            added = Stored((folder,), rows.schema.json())
            if notes and self._load(added).isEmpty():
                self.files.delete(folder)
                self.tables[name] = Stored(folders, notes[0].schema)
                return self.read(name)
            following = f"versions/{name}/{int(taken[-1]) + 1 if taken else 1:012d}"
            if self.files.create(following, json.dumps(added.note())):
                self.tables[name] = Stored((*folders, folder), added.schema)
                return self.read(name)
            self.files.delete(folder)

    def drop(self, name: str) -> None:
        if (stored := self.tables.pop(name, None)) is not None:
            for folder in stored.folders:
                self.files.delete(folder)

    def identity(self, name: str) -> str | None:
        """Tells this content of the table from every other."""
        return "|".join(self.tables[name].folders) if name in self.tables else None

    def kept(self, name: str, fingerprint: str) -> DataFrame | None:
        """The table that some run made from the same inputs, if it is still there."""
        text = self.files.read(f"done/{fingerprint}")
        if text is None:
            return None
        note = json.loads(text)
        stored = Stored.of(note)
        if not all(self.files.exists(f) for f in stored.folders):
            return None
        self.tables[name] = stored
        self.notes[name] = note.get("measures")
        return self.read(name)

    def noted(self, name: str) -> dict[str, int | None] | None:
        """What was kept with the table that `kept` found."""
        return self.notes.get(name)

    def keep(self, name: str, fingerprint: str, measures: Mapping[str, int | None] | None = None) -> None:
        self.files.replace(f"done/{fingerprint}", json.dumps({**self.tables[name].note(), "measures": measures}))

    def publish(self) -> None:
        """From now on readers get this run."""
        shown = {n: t.note() for n, t in self.tables.items() if not n.startswith(SCRATCH)}
        known = {"run": self.run, "published": _now().isoformat(), "tables": shown}
        self.files.replace(POINTER, json.dumps(known))
        for name in [n for n in self.tables if n.startswith(SCRATCH)]:
            self.files.delete(self.tables.pop(name).folders[0])

    def remove_old_runs(self, grace: timedelta, now: datetime | None = None) -> list[str]:
        """Delete runs that no table of the published run comes from. A run stays until `grace` has passed since it began
        and since the pointer moved: `grace` must be longer than a build and than a reader's session."""
        text = self.files.read(POINTER)
        if text is None:
            return []
        known, now = json.loads(text), now or _now()
        if now - datetime.fromisoformat(known["published"]) < grace:
            return []
        used = {f.split("/")[1] for t in known["tables"].values() for f in t["folders"] if f.startswith("runs/")}
        gone = []
        for name in self.files.names("runs"):
            run = name.removesuffix(".json")
            if name == run or run in {known["run"], *used}:
                continue
            started = json.loads(self.files.read(f"runs/{name}"))["started"]
            if now - datetime.fromisoformat(started) >= grace:
                self.files.delete(f"runs/{run}")
                self.files.delete(f"runs/{name}")
                gone.append(run)
        for fingerprint in self.files.names("done"):
            stored = Stored.of(json.loads(self.files.read(f"done/{fingerprint}")))
            if not all(self.files.exists(f) for f in stored.folders):
                self.files.delete(f"done/{fingerprint}")
        return gone


def _now() -> datetime:
    return datetime.now(UTC)
