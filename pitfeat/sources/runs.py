"""Run registry: a run exists once a version names all its parts.

A run saves its parts (models, tables, figures) under a folder of its own and then publishes one numbered entry that lists them. Entries are created once, so two runs that end
together get two numbers, and one that is killed while saving is never found. Whether the parts that an entry names are there is checked when it is published.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from pitfeat.sources import commits
from pitfeat.sources.commits import Versions

ENTRY = "number long, name string, path string, run_at string, parts array<string>, meta string"


@dataclass(frozen=True)
class Run:
    """A complete run."""

    number: int
    name: str
    path: str
    run_at: str
    parts: tuple[str, ...]
    meta: dict

    def part(self, name: str) -> str:
        if name not in self.parts:
            raise KeyError(f"run {self.number} has {list(self.parts)}")
        return f"{self.path}/{name}"


class Runs:
    """The runs stored under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.entries = Versions(spark, f"{self.root}/entries")

    def record(self, name: str, save: Callable[[str], Sequence[str]], meta: Mapping, run_at: dt.datetime) -> Run:
        """Saves a run and publishes it. ``save`` writes its parts below the folder it is given and returns their names."""
        path = f"{self.root}/runs/{name}-{uuid.uuid4().hex}"
        parts = tuple(save(path))
        there = set(commits.names(self.spark, path))
        if missing := [p for p in parts if p.split("/")[0] not in there]:
            raise FileNotFoundError(f"{path} lacks {missing}")
        numbers = self.entries.numbers()
        number = numbers[-1] if numbers else 0
        while True:
            number += 1
            run = Run(number, name, path, run_at.isoformat(), parts, dict(meta))
            if self.entries.create(number, json.dumps(asdict(run))):
                return run

    def get(self, number: int) -> Run:
        d = json.loads(self.entries.read(number))
        return Run(**d | {"parts": tuple(d["parts"])})

    def latest(self, name: str) -> Run | None:
        """The newest complete run of a name, by time, then number."""
        runs = [r for r in map(self.get, self.entries.numbers()) if r.name == name]
        return max(runs, key=lambda r: (dt.datetime.fromisoformat(r.run_at), r.number), default=None)

    def best(self, name: str, metric: str, largest: bool = True) -> Run | None:
        """The run of a name with the best figure of that name in its meta data; the newest of equal ones."""
        runs = [r for r in map(self.get, self.entries.numbers()) if r.name == name and r.meta.get(metric) is not None]
        return max(runs, key=lambda r: (r.meta[metric] if largest else -r.meta[metric], r.run_at, r.number), default=None)

    def table(self) -> DataFrame:
        rows = [(r.number, r.name, r.path, r.run_at, list(r.parts), json.dumps(r.meta)) for r in map(self.get, self.entries.numbers())]
        return self.spark.createDataFrame(rows, ENTRY)

    def orphans(self) -> list[str]:
        """Folders of runs that were never published."""
        named = {self.get(n).path.rsplit("/", 1)[1] for n in self.entries.numbers()}
        return [x for x in commits.names(self.spark, f"{self.root}/runs") if x not in named]

    def clean(self, older_than: float = 86_400) -> list[str]:
        """Deletes folders of runs that were never published, if nothing has changed in them for so many seconds."""
        age = commits.ages(self.spark, f"{self.root}/runs")
        gone = [x for x in self.orphans() if age.get(x, 0) >= older_than]
        for x in gone:
            commits.delete(self.spark, f"{self.root}/runs/{x}")
        return gone
