"""Row counts of every layer, taken while it is written, and limits that stop a run.

Counts are observed on the pass that writes a layer, so they cost no job of their own. A part of a plan that a lost executor
makes run again may be counted again; limits are shares for that reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession


class GateFailed(RuntimeError):
    """A limit was passed; the report was written before the run stopped."""


@dataclass(frozen=True)
class Gate:
    """In a layer the rows counted as `part` may be `most` of those counted as `whole`."""

    layer: str
    part: str
    whole: str
    most: float


class Report:
    """Counts by layer and measure."""

    def __init__(self):
        self._observed: list[tuple[str, Observation]] = []
        self._known: dict[tuple[str, str], int] = {}

    def observed(self, df: DataFrame, layer: str, **measures: Column) -> DataFrame:
        """The frame, counted when it is written."""
        seen = Observation()
        self._observed.append((layer, seen))
        return df.observe(seen, *[c.alias(name) for name, c in measures.items()])

    def counts(self) -> dict[tuple[str, str], int]:
        """What was counted so far; to be called when the layers observed until now have been written."""
        for layer, seen in self._observed:
            self._known |= {(layer, name): int(n or 0) for name, n in seen.get.items()}
        self._observed.clear()
        return self._known

    def add(self, layer: str, measure: str, n: int) -> None:
        self._known[layer, measure] = n

    def check(self, gates: Sequence[Gate]) -> None:
        """Raises if a limit is passed. Gates of layers without counts are for later."""
        known = self.counts()
        for g in gates:
            part, whole = known.get((g.layer, g.part)), known.get((g.layer, g.whole))
            if part is not None and whole is not None and part > g.most * whole:
                raise GateFailed(f"{g.layer}: {part} of {whole} {g.whole} are {g.part}, more than {g.most:.2%}")

    def frame(self, spark: SparkSession) -> DataFrame:
        """(layer, measure, value), a row per count."""
        rows = [(layer, measure, n) for (layer, measure), n in sorted(self.counts().items())]
        return spark.createDataFrame(rows, "layer string, measure string, value bigint")
