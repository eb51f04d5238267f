"""Stateful streams over frames: the flicker meter, the sliding stabiliser and the range guard, equal to the batch results.

All keep their state by episode, so a hot episode costs a task its time but not its memory: the meter keeps three numbers,
the stabiliser as many frames as it reaches, the guard one count for each value that half precision can hold. Frames of an
episode must come in order from batch to batch; within a batch they are sorted. State outlives a restart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

METER = "ep long, compared long, changed long"
STEADY = "ep long, ordinal long, median double, voted int, raw int"
GUARD = "ep long, valid long, near long, far long, median double"


class FlickerMeter(StatefulProcessor):
    """Counts frames and changes of class; the totals so far go out after every batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "previous int, compared long, changed long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        previous, compared, changed = self.seen.get() if self.seen.exists() else (None, 0, 0)
        parts = [(p["ordinal"].to_numpy(), p["cls"].to_numpy(np.int32)) for p in rows]
        order = np.argsort(np.concatenate([o for o, _ in parts]), kind="stable")
        cls = np.concatenate([c for _, c in parts])[order]
        if previous is not None:
            cls = np.concatenate([np.array([previous], np.int32), cls])
        compared, changed = compared + len(cls) - 1, changed + int((cls[1:] != cls[:-1]).sum())
        self.seen.update((int(cls[-1]), int(compared), int(changed)))
        yield pd.DataFrame({"ep": [key[0]], "compared": [compared], "changed": [changed]})

    def close(self) -> None:
        pass


def steady(ordinals: np.ndarray, depths: np.ndarray, classes: np.ndarray, first: int, stop: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(medians, votes) of the frames first..stop - 1, from the frames given, by number; those that aren't there don't count.
    The median is of the depths above 0, 0 without any; in the vote a frame counts twice for itself, and the lowest class of
    equals wins."""
    n = stop - first
    d, c = np.full(n + 2 * radius, np.nan), np.full(n + 2 * radius, -1)
    at = ordinals - first + radius
    ok = (at >= 0) & (at < len(d))
    d[at[ok]], c[at[ok]] = np.where(depths[ok] > 0, depths[ok], np.nan), classes[ok]
    near = np.sort(np.lib.stride_tricks.sliding_window_view(d, 2 * radius + 1), axis=1)  # missing ones come last
    k = (~np.isnan(near)).sum(1)
    row, low, high = np.arange(n), np.maximum(k - 1, 0) // 2, k // 2
    middle = np.where(k > 0, (near[row, low] + near[row, np.minimum(high, 2 * radius)]) / 2, 0.0)
    around = np.lib.stride_tricks.sliding_window_view(c, 2 * radius + 1)
    votes = np.stack([(around == x).sum(1) + (around[:, radius] == x) for x in range(max(int(c.max(initial=0)), 0) + 1)], 1)
    return middle, votes.argmax(1)


class WindowStabiliser(StatefulProcessor):
    """Median depth and class by vote within a radius: a frame goes out, with its class as it came, once the frames after it
    are there, and the rest of an episode when its end is announced by a row without an ordinal."""

    radius = 2

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "ordinals array<long>, depths array<double>, classes array<int>, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        o, d, c, due = self.held.get() if self.held.exists() else ([], [], [], 0)
        o, d, c, ended = [np.array(o, np.int64)], [np.array(d, float)], [np.array(c, np.int64)], False
        for part in rows:
            real = part["ordinal"].notna().to_numpy()
            ended |= not real.all()
            o.append(part["ordinal"].to_numpy()[real].astype(np.int64))
            d.append(part["depth"].to_numpy(float)[real])
            c.append(part["cls"].to_numpy()[real].astype(np.int64))
        o, d, c = np.concatenate(o), np.concatenate(d), np.concatenate(c)
        last = int(o.max(initial=-1))
        stop = last + 1 if ended else last + 1 - self.radius
        if stop > due:
            middle, voted = steady(o, d, c, due, stop, self.radius)
            there = np.flatnonzero((o >= due) & (o < stop))
            at = o[there] - due
            yield pd.DataFrame({"ep": key[0], "ordinal": o[there], "median": middle[at], "voted": voted[at].astype(np.int32), "raw": c[there].astype(np.int32)})
            due = stop
        keep = (o >= due - self.radius) & (not ended)
        self.held.update((o[keep].tolist(), d[keep].tolist(), c[keep].tolist(), due))

    def close(self) -> None:
        pass


class RangeGuard(StatefulProcessor):
    """How many depths lie beyond either end of the range, and their median, from counts by value in half precision. After a
    restart it goes on where it was."""

    near, far = 50.0, 400.0

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "valid long, near long, far long, codes array<int>, weights array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        valid, near, far, codes, weights = self.seen.get() if self.seen.exists() else (0, 0, 0, [], [])
        counts = np.zeros(1 << 16, np.int64)
        counts[np.array(codes, np.int64)] = weights
        for part in rows:
            d = part["depth"].to_numpy(np.float32)
            d = d[np.isfinite(d) & (d > 0)]
            valid, near, far = valid + len(d), near + int((d < self.near).sum()), far + int((d > self.far).sum())
            counts += np.bincount(d.astype(np.float16).view(np.uint16), minlength=1 << 16)
        some = np.flatnonzero(counts)
        self.seen.update((int(valid), int(near), int(far), some.tolist(), counts[some].tolist()))
        upto = np.cumsum(counts)  # patterns of numbers above 0 are in the order of the numbers
        pair = np.searchsorted(upto, [(valid + 1) // 2, valid // 2 + 1]).astype(np.uint16)
        median = float(pair.view(np.float16).astype(float).mean()) if valid else 0.0
        yield pd.DataFrame({"ep": [key[0]], "valid": [valid], "near": [near], "far": [far], "median": [median]})

    def close(self) -> None:
        pass


def set_up(spark: SparkSession) -> None:
    """State lives in RocksDB, which spills to disk, instead of the heap. A session that names a provider keeps it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if key not in spark.conf.getAll:
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def flicker_stream(frames: DataFrame) -> DataFrame:
    """(ep, compared, changed) after every batch of a stream of (ep, ordinal, cls)."""
    return frames.groupBy("ep").transformWithStateInPandas(FlickerMeter(), METER, "Update", "None")


def steady_stream(frames: DataFrame) -> DataFrame:
    """(ep, ordinal, median, voted, raw) of all frames of a stream of (ep, ordinal, depth, cls); a row with a null ordinal ends
    its episode and releases what still waits for neighbours."""
    return frames.groupBy("ep").transformWithStateInPandas(WindowStabiliser(), STEADY, "Append", "None")


def guard_stream(frames: DataFrame) -> DataFrame:
    """(ep, valid, near, far, median) after every batch of a stream of (ep, depth)."""
    return frames.groupBy("ep").transformWithStateInPandas(RangeGuard(), GUARD, "Update", "None")


def daily_counts(events: DataFrame, *, late: str = "2 hours") -> DataFrame:
    """Events a day and type; a day goes out once the watermark, the latest time less ``late``, has passed its end."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    n = e.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return n.select(F.col("w.start").alias("day"), "event_type", "n")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    """Runs the stream over all there is, into Parquet; repeats after a failure write each batch once, and a later call with
    the same checkpoint goes on from there."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    q = stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
