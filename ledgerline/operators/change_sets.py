"""Change sets that rewrite only what they touch (M1, M4, M5 on a stored table).

The raw table is a parted table of a ``Warehouse``: hash parts of its key. A change set is
first written to the warehouse's log, so it is the same in every later step. The parts that
its keys fall into are read from the version it is built on, changed by the operators
of ``changes`` and written as a new version; all other parts stay the files that they are.
A change set over few keys thus reads and writes (keys / parts) of the table, one over very
many keys rewrites it once, like ``changes`` does. The number of parts is the unit of
rewriting: choose it so that a part is a file or two (table size / 256 MB).

Two writers that start from one version: the first to publish wins, the other gets
``Superseded`` and applies its change set again.

Defined results: as the operators of ``changes`` (null keys lie in one part and are never
updated or deleted; keys repeated within a creating set are held back as conflicts); a change
set without rows publishes nothing; a part left without rows is marked empty.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..sources.sinks import Warehouse, new_version
from . import changes


@dataclass
class Change:
    """``version``: the newest one after the change. ``touched``: the parts written.
    ``problems``: the conflicts of a creating set, else the keys not found."""
    version: str | None
    touched: list[int]
    problems: DataFrame


class ChangeTable:
    def __init__(self, wh: Warehouse, name: str):
        self.wh, self.name, self.key = wh, name, wh.parted[name][0]

    def load(self, rows: DataFrame) -> str:
        """The whole table as a new version, in place of what it held."""
        parent, version = self.wh.current_version(), new_version()
        entries = self.wh.stage_parts(self.name, rows, None, version)
        self.wh.mark(version, entries, parent)
        return version

    def rows(self, version: str | None = None) -> DataFrame:
        return self.wh.table(self.name, version)

    def create(self, batch: DataFrame) -> Change:
        """M1: rows with new keys; ``problems`` holds the conflicts."""
        def step(old: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
            made = changes.create_rows(old, batch, self.key)
            return made.table, made.conflicts
        return self._apply(batch, step)

    def update(self, updates: DataFrame, **options) -> Change:
        """M4: partial updates, merged field by field (see ``changes.apply_updates``)."""
        return self._apply(updates, lambda old, upd: changes.apply_updates(
            old, upd, self.key, **options))

    def delete(self, keys: DataFrame) -> Change:
        """M5: rows with the listed keys go."""
        return self._apply(keys, lambda old, k: changes.delete_rows(old, k, self.key))

    def replace(self, keys: DataFrame, rows: DataFrame) -> Change:
        """The rows of the listed keys go, ``rows`` (of those keys alone) come in their place."""
        def step(old: DataFrame, k: DataFrame) -> tuple[DataFrame, DataFrame]:
            left, missing = changes.delete_rows(old, k, self.key)
            return left.unionByName(rows.select(*old.columns)), missing
        return self._apply(keys.select(self.key).dropna().distinct(), step)

    def _apply(self, batch: DataFrame, step: Callable[[DataFrame, DataFrame], tuple[
            DataFrame, DataFrame]]) -> Change:
        wh, parent, version = self.wh, self.wh.current_version(), new_version()
        log = f"{wh.root}/changes/{self.name}/v={version}"
        batch.write.mode("errorifexists").parquet(log)
        batch = wh.spark.read.schema(batch.schema).parquet(log)
        touched = wh.touched(self.name, batch)
        old = wh.parts(self.name, touched, parent)
        new, problems = step(old, batch)
        if touched:
            wh.mark(version, wh.stage_parts(self.name, new, touched, version), parent)
        return Change(version if touched else parent, touched, problems)
