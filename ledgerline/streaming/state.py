"""Nightly state as streams: upserts, ledgers with an age limit, streaks, late rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.fold import latest
from ..operators.guards import LEDGER_DAYS, SWEEP_DAYS


def late_rows(stream: DataFrame, keys: list[str], at: str, days: int = SWEEP_DAYS) -> DataFrame:
    """Each key once within the window; rows older than it are too late."""
    return stream.withWatermark(at, f"{days} days").dropDuplicatesWithinWatermark(keys)


def ledger(stream: DataFrame, key: str, at: str, days: int = LEDGER_DAYS) -> DataFrame:
    """First flip of each key; a key is forgotten, and may flip again, after a year of event time."""
    return stream.withWatermark(at, f"{days} days").dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, at: str, group: str, delay: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Tumbling counts (an extension: the nightly programs have no windows)."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, width), group).agg(F.count("*").alias("n"))


def streaks(stream: DataFrame, entity: str, night: str, leaked: str) -> DataFrame:
    """entity, nights, last after each batch: a night counts once, a clean one resets. State is one small row per entity."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        nights, last = state.get if state.exists else (0, "")
        rows = pd.concat(list(frames)).groupby(night)[leaked].any().sort_index()
        for day, bad in rows.items():
            if day <= last:
                continue
            nights, last = (nights + 1 if bad else 0), day
        state.update((nights, last))
        yield pd.DataFrame({entity: [key[0]], "nights": [nights], "last": [last]})

    return stream.select(entity, night, leaked).groupBy(entity).applyInPandasWithState(step, f"{entity} string, nights long, last string", "nights long, last string", "update", GroupStateTimeout.NoTimeout)


def upsert(read: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], keys: list[str], seq: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that folds each batch into a snapshot: the last row of each key stands.

    write gets the new snapshot and the batch number, and must replace it as a whole (write apart, then swap), so a
    repeated batch has the same outcome.
    """

    def step(batch: DataFrame, number: int) -> None:
        old = read()
        write(latest(batch if old is None else old.unionByName(batch), keys, seq), number)

    return step
