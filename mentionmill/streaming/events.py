"""Streams of events: sessions, first sightings, and replays that end as a batch would."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, NumericType, StringType, StructField, StructType, TimestampType

from mentionmill.runtime import Scratch

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LEAST_PARTITIONS = 8


def sessions(stream: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """``key, start, end, n``: rows of a key less than ``gap`` apart are a session; it is told once the watermark has passed its end."""
    windows = stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key)
    return windows.agg(F.count("*").alias("n"), F.max(time).alias("end")).select(key, F.col("w.start").alias("start"), "end", "n")


def first_seen(stream: DataFrame, time: str, key: str, horizon: float, late: str = "10 minutes", order: str | None = None, buckets: int = 512) -> DataFrame:
    """Rows whose key has no row in the ``horizon`` seconds before.

    Keys are dealt to ``buckets`` by their hash, and state is a bucket's keys
    with the time of their last rows, so that calls and timers are as many as
    buckets, however many keys there are. A key is dropped ``horizon`` after its
    last row, when it can no longer matter: with the next rows of its bucket, or
    by the bucket's timer; state holds the keys of one horizon only. Batches
    come in the order of time; rows of one batch are sorted, those of one time
    by the integer column ``order`` (nulls last). A null key is a key; rows
    without a time are left out. A task holds a bucket's rows of one batch.
    """

    class FirstSeen(StatefulProcessor):  # local, so that it goes to the workers whole
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle, self.last = handle, handle.getValueState("last", "names array<string>, micros array<long>, timed boolean")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            frame = pd.concat(list(rows), ignore_index=True)
            name, names = pd.factorize(frame[f"{own}name"], use_na_sentinel=False)
            names = [None if pd.isna(n) else n for n in names]
            old, micros, timed = self.last.get() or ([], [], False)
            kept = dict(zip(old, micros, strict=True))
            at = frame[f"{own}at"].to_numpy(np.int64)
            turn = np.lexsort((frame[f"{own}order"].to_numpy(np.int64), at, name))
            name, at = name[turn], at[turn]
            new = np.append(True, name[1:] != name[:-1])
            never = np.iinfo(np.int64).min
            before = np.array([kept.get(n, never) for n in names], np.int64)[name]
            before[1:] = np.where(new[1:], before[1:], np.maximum(before[1:], at[:-1]))
            told = (before == never) | (at - np.where(before == never, at, before) > wait)
            ends = np.append(new[1:], True)
            kept |= {names[n]: max(int(t), kept.get(names[n], never)) for n, t in zip(name[ends], at[ends], strict=True)}
            self._keep(kept, timerValues, timed)
            yield frame.loc[np.sort(turn[told]), [f.name for f in sent]]

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            names, micros, _ = self.last.get() or ([], [], False)
            self._keep(dict(zip(names, micros, strict=True)), timerValues, False)
            return iter(())

        def _keep(self, kept: dict, timerValues, timed: bool) -> None:
            """Store what can still matter; one timer a bucket, for when none of it will. Each call of these waits for the state's server."""
            mark = timerValues.getCurrentWatermarkInMs() * 1000
            kept = {n: t for n, t in kept.items() if t + wait >= mark}
            if kept and not timed:
                self.handle.registerTimer((max(kept.values()) + wait) // 1000 + 1)
            if kept or timed:
                self.last.update((list(kept), list(kept.values()), True))
            else:
                self.last.clear()

        def close(self) -> None:
            pass

    wait, own = int(horizon * 1_000_000), "first_seen_"
    # pandas has no integers with nulls, nulls beside NaN or times of all zones: numbers and times travel as text
    there = {f.name: _as_text(F.col(f"`{f.name}`"), f.dataType) for f in stream.schema}
    sent = [StructField(f"{own}{k}", StringType() if there[f.name] is not None else f.dataType) for k, f in enumerate(stream.schema)]
    named = there[key] if there[key] is not None else F.col(f"`{key}`")
    named = named if isinstance(stream.schema[key].dataType, StringType) or there[key] is not None else F.to_json(F.struct(named))
    micros, turn = F.unix_micros(F.col(f"`{time}`").cast("timestamp")), F.coalesce(F.col(f"`{order}`").cast("long"), F.lit(2**63 - 1)) if order else F.lit(0).cast("long")
    rows = stream.withWatermark(time, late).where(F.col(f"`{time}`").isNotNull())
    rows = rows.select(F.col(f"`{time}`"), *[(F.col(f"`{f.name}`") if there[f.name] is None else there[f.name]).alias(s.name) for f, s in zip(stream.schema, sent, strict=True)], named.alias(f"{own}name"), micros.alias(f"{own}at"), turn.alias(f"{own}order"))
    rows = rows.withColumn(f"{own}bucket", F.pmod(F.xxhash64(f"{own}name"), F.lit(buckets))).groupBy(f"{own}bucket")
    told = rows.transformWithStateInPandas(FirstSeen(), outputStructType=StructType(sent), outputMode="Append", timeMode="EventTime")
    return told.select(*[_from_text(F.col(s.name), f.dataType, there[f.name] is not None).alias(f.name) for f, s in zip(stream.schema, sent, strict=True)])


def _as_text(c: Column, kind: DataType) -> Column | None:
    """Numbers and times as text that :func:`_from_text` reads back whole; nothing for other types."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(c).cast("string")
    return c.cast("string") if isinstance(kind, NumericType) else None


def _from_text(c: Column, kind: DataType, text: bool) -> Column:
    if text and isinstance(kind, TimestampType):
        return F.timestamp_micros(c.cast("long"))
    return c.cast(kind) if text else c


def replayed(spark: SparkSession, waves: list[DataFrame], build: Callable[[DataFrame], DataFrame], job: str, again: bool = False) -> DataFrame:
    """What ``build(stream)`` has told once all ``waves`` have arrived as files, one after the other.

    The stream is started for each wave and ends when it has read all there is;
    what it goes on from is its checkpoint, as after any stop. ``again`` starts
    it once more without a new file, which adds nothing. Source, state and
    result lie in the shared folder; the streams run in a session of their own,
    whose state store is RocksDB. Each partition of state starts a worker and
    commits its store in every batch, rows or not, so there are not more of them
    than cores (and ``LEAST_PARTITIONS``), however many a batch job would have.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    session.conf.set("spark.sql.shuffle.partitions", min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(LEAST_PARTITIONS, spark.sparkContext.defaultParallelism)))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    folder, schema = Scratch(spark, job).folder, waves[0].schema
    for wave in [*waves, *([None] if again else [])]:
        if wave is not None:
            wave.write.mode("append").parquet(f"{folder}/arrived")
        told = build(session.readStream.schema(schema).parquet(f"{folder}/arrived"))
        write = told.writeStream.format("parquet").option("path", f"{folder}/told").option("checkpointLocation", f"{folder}/checkpoint").outputMode("append")
        write.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(told.schema).parquet(f"{folder}/told")
