"""Producers of output tables, processors of typed events, row generators and callbacks."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import Fold, folded

log = logging.getLogger(__name__)
Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class Producer:
    name: str
    target: str
    inputs: tuple[str, ...]
    versions: int
    make: Callable[[Tables], DataFrame]


@dataclass
class Registry:
    """Producers by name; processors by the kind of event they take."""

    producers: dict[str, Producer] = field(default_factory=dict)
    processors: dict[str, list[Callable[[DataFrame], DataFrame]]] = field(default_factory=dict)
    folds: dict[str, Fold] = field(default_factory=dict)

    def producer(self, target: str, inputs: tuple[str, ...], versions: int = -1):
        """Marks a function of the input tables as the producer of the table of its name."""

        def mark(make: Callable[[Tables], DataFrame]):
            self.producers[make.__name__] = Producer(make.__name__, target, inputs, versions, make)
            return make

        return mark

    def processor(self, kind: str):
        """Marks a function of the events of one kind."""

        def mark(process: Callable[[DataFrame], DataFrame]):
            self.processors.setdefault(kind, []).append(process)
            return process

        return mark

    def fold(self, fold: Fold) -> Fold:
        """Adds a processor that folds its events into one result for each capture."""
        self.folds[fold.name] = fold
        return fold

    def fold_all(self, events: DataFrame, key: tuple[str, ...] = ("capture_id",)) -> dict[str, DataFrame]:
        """The results of all folds, in one pass over the events."""
        return folded(events, list(self.folds.values()), key)

    def produce(self, tables: Tables, target: str | None = None, version: int = -1) -> tuple[Tables, dict[str, Exception]]:
        """The tables whose inputs are there and whose target and version fit; a producer that fails is logged and reported, and the rest go on."""
        out, failed = {}, {}
        for p in self.producers.values():
            if (target in (None, p.target)) and p.versions & version and all(i in tables for i in p.inputs):
                try:
                    out[p.name] = p.make(tables)
                except Exception as e:  # noqa: BLE001  one producer must not stop the others
                    log.exception("producer %s failed", p.name)
                    failed[p.name] = e
        return out, failed

    def process(self, events: DataFrame) -> dict[str, list[DataFrame]]:
        """Each processor over the events of its kind."""
        return {kind: [f(events.where(F.col("kind") == kind)) for f in fs] for kind, fs in self.processors.items()}


def on_records(stream: DataFrame, callback: Callable[[DataFrame], None], checkpoint: str):
    """Calls back with the records of each trigger as they come."""
    return stream.writeStream.foreachBatch(lambda df, _: callback(df)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
