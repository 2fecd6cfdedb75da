"""Lag and rolling features of a stream, with state per station.

A call of a state from Python costs far more than a row, so keys are dealt by a hash into
``groups`` groups, and ``transformWithState`` runs once for a group: its state holds, for
each of its keys, the place of the last row (time and id) and the last ``max(lags,
windows)`` values, and is read and written once a micro-batch, however many keys there are.
The rows of all keys of a group are worked on together. An event-time timer per group ends
the state of the keys that have been silent for ``expire``. The rows of a micro-batch come
in any order and in any number: up to ``chunk_rows`` of a group are held in memory; beyond
that they are dealt into time buckets of a state map and read back one bucket after the
other, so what a task holds is a bucket and never all rows of a group.

Rows are ordered by (time, id). A row that comes after a later one was emitted is dropped
and counted in ``late_dropped`` of the rows that follow. A gap of more than ``expire``
between two rows of a key starts its history anew, whether or not the timer came first, so
the result does not depend on where micro-batches are cut. State lives in RocksDB, which
``transformWithState`` requires; the session's state store is set to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from aerolytics.constants import PM25_LAGS, ROLLING_WINDOWS
from aerolytics.functions.calendar import instant_to_ntz, ntz_to_instant

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHUNK_ROWS = 100_000
GROUPS = 512
HOUR_US = 3_600_000_000


def lag_processor(names: list[str], lags, windows, expire_us: int | None, chunk_rows: int, bucket_us: int):
    """The stateful processor; defined inside, so that it is sent by value."""
    import itertools

    import numpy as np
    import pandas as pd

    depth = max([*lags, *windows])

    def features(every, at, first):
        """Lags and previous-row frames of the rows at ``at`` of ``every``; the history of a row starts at ``first``."""
        back = at[:, None] - np.arange(1, depth + 1)[None, :]
        held = np.where(back >= first[:, None], every[np.maximum(back, 0)], np.nan)
        out = [held[:, k - 1] for k in lags]
        for w in windows:
            part = held[:, :w]
            have = ~np.isnan(part)
            count = have.sum(axis=1)
            mean = np.where(have, part, 0.0).sum(axis=1) / np.where(count > 0, count, np.nan)
            spread = (np.where(have, part - mean[:, None], 0.0) ** 2).sum(axis=1)
            out += [mean, np.where(count > 1, np.sqrt(spread / np.maximum(count - 1, 1)), 0.0)]
        return out

    def expiry(us: int) -> int:
        """Time of the timer (ms) of a key whose last row is at ``us``."""
        return (us + expire_us) // 1000 + 1

    class Lags(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.kept = handle.getValueState("kept", "key array<string>, us array<long>, id array<long>, "
                                                     "n array<int>, v array<double>")
            self.waiting = handle.getMapState("waiting", "bucket long, part long",
                                              "key array<string>, us array<long>, id array<long>, v array<double>")

        def _load(self) -> dict:
            """Time and id of the last row, and the last values, of each key."""
            if not self.kept.exists():
                return {}
            keys, us, ids, n, v = self.kept.get()
            ends = np.cumsum(n)
            values = np.array(v, dtype=float)
            return {k: (u, i, values[e - c:e]) for k, u, i, c, e in zip(keys, us, ids, n, ends)}

        def _store(self, last: dict) -> None:
            rows = list(last.values())
            self.kept.update((list(last), [r[0] for r in rows], [r[1] for r in rows], [len(r[2]) for r in rows],
                              np.concatenate([r[2] for r in rows]).tolist()))

        def _park(self, held, part: int) -> int:
            """Move rows from memory to the map, by time bucket."""
            for pdf in held:
                for bucket, g in pdf.groupby(pdf["us"] // bucket_us):
                    keys = [None if pd.isna(k) else k for k in g["key"]]
                    self.waiting.updateValue((int(bucket), part), (keys, g["us"].tolist(), g["id"].tolist(), g["v"].tolist()))
                    part += 1
            return part

        def _chunks(self, rows):
            held, n, part = [], 0, 0
            for pdf in rows:
                held.append(pdf[["key", "us", "id", "v"]])
                n += len(pdf)
                if n > chunk_rows:
                    part, held, n = self._park(held, part), [], 0
            if not part:
                if held:
                    yield pd.concat(held)
                return
            self._park(held, part)
            places = sorted(tuple(k) for k in self.waiting.keys())
            for _, of_bucket in itertools.groupby(places, key=lambda place: place[0]):
                yield self._read(of_bucket)

        def _read(self, places):
            parts = []
            for place in places:
                keys, us, ids, v = self.waiting.getValue(place)
                parts.append(pd.DataFrame({"key": np.array(keys, dtype=object), "us": np.array(us, np.int64),
                                           "id": np.array(ids, np.int64), "v": np.array(v, dtype=float)}))
                self.waiting.removeKey(place)
            return pd.concat(parts)

        def _chunk(self, pdf, last: dict, late: dict):
            """Rows of a chunk with their features; ``last`` and ``late`` (by key) go on."""
            code, keys = pd.factorize(pdf["key"], use_na_sentinel=False)
            keys = [None if pd.isna(k) else k for k in keys]
            pdf = pdf.assign(code=code).sort_values(["code", "us", "id"])
            code, us, ids = (pdf[c].to_numpy(np.int64) for c in ("code", "us", "id"))
            v = pdf["v"].to_numpy(float)
            known = np.array([k in last for k in keys])
            none = (0, 0, np.empty(0))
            before = [last.get(k, none) for k in keys]
            last_us, last_id = (np.array([b[j] for b in before], np.int64) for j in (0, 1))
            new = ~known[code] | (us > last_us[code]) | ((us == last_us[code]) & (ids > last_id[code]))
            if not new.all():
                for c, n in enumerate(np.bincount(code[~new], minlength=len(keys)).tolist()):
                    late[keys[c]] = late.get(keys[c], 0) + n
                code, us, ids, v = code[new], us[new], ids[new], v[new]
            if not len(us):
                return None
            begins = np.concatenate([[True], code[1:] != code[:-1]])
            earlier = np.where(begins, np.where(known[code], last_us[code], us), np.concatenate([us[:1], us[:-1]]))
            fresh = us - earlier > expire_us if expire_us is not None else np.zeros(len(us), bool)
            # the values of each key: those kept, then those of the chunk
            here = code[begins]
            kept = np.zeros(len(keys), np.int64)
            kept[here] = [len(before[c][2]) for c in here]
            at = np.arange(len(us)) + np.cumsum(kept)[code]
            every = np.empty(len(us) + int(kept.sum()))
            old = np.ones(len(every), bool)
            old[at] = False
            every[at] = v
            every[old] = np.concatenate([before[c][2] for c in here])
            first = np.maximum.accumulate(np.where(fresh, at, np.where(begins, at - kept[code], 0)))
            for i in np.flatnonzero(np.concatenate([begins[1:], [True]])).tolist():
                end = int(at[i]) + 1
                last[keys[code[i]]] = (int(us[i]), int(ids[i]), every[max(int(first[i]), end - depth):end].copy())
            dropped = np.array([late.get(k, 0) for k in keys], np.int64)
            return pd.DataFrame({"id": ids, "key": np.array(keys, dtype=object)[code], "us": us, "v": v,
                                 **dict(zip(names, features(every, at, first))), "late_dropped": dropped[code]})

        def _set_timer(self, last: dict) -> None:
            self.handle.registerTimer(expiry(min(r[0] for r in last.values())))

        def handleInputRows(self, key, rows, timerValues):
            last, late = self._load(), {}
            for pdf in self._chunks(rows):
                out = self._chunk(pdf, last, late)
                if out is not None:
                    yield out
            if not last:
                return
            self._store(last)
            if expire_us is not None:
                for t in list(self.handle.listTimers()):
                    self.handle.deleteTimer(t)
                self._set_timer(last)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            now = timerValues.getCurrentWatermarkInMs()
            last = {k: r for k, r in self._load().items() if expiry(r[0]) > now}
            if last:
                self._store(last)
                self._set_timer(last)
            else:
                self.kept.clear()
            return iter([])

        def close(self) -> None:
            pass

    return Lags()


def _micros(interval: str) -> int:
    """Microseconds of an interval like ``36 hours``."""
    n, unit = interval.split()
    return int(float(n) * {"second": 10**6, "minute": 6 * 10**7, "hour": HOUR_US, "day": 24 * HOUR_US}[unit.rstrip("s")])


def lag_state_stream(stream: DataFrame, key: str = "station", time: str = "datetime",
                     value: str = "pm25", lags=PM25_LAGS, windows=ROLLING_WINDOWS,
                     id_col: str = "event_id", expire: str | None = None, delay: str = "1 hour",
                     chunk_rows: int = CHUNK_ROWS, bucket_us: int = HOUR_US, groups: int = GROUPS) -> DataFrame:
    """Per-key lags and previous-row rolling mean / std across micro-batches.

    ``expire``: a key silent for longer starts anew; its state is ended by a timer once the
    watermark (greatest event time - ``delay``) has passed. A value that is missing is NULL,
    a deviation of fewer than two values 0. ``groups``: see the module; it must not change
    while a checkpoint is in use.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    names = [f"{value}_lag{k}" for k in lags]
    for w in windows:
        names += [f"{value}_roll_mean{w}", f"{value}_roll_std{w}"]
    instant = ntz_to_instant(time) if stream.schema[time].dataType.simpleString() == "timestamp_ntz" else F.col(time)
    kind = stream.schema[key].dataType.simpleString()
    text = F.hex(key) if kind == "binary" else F.col(key).cast("string")
    rows = stream.select(F.col(id_col).cast("long").alias("id"), text.alias("key"), instant.alias("t"),
                         F.col(value).cast("double").alias("v"), F.pmod(F.xxhash64(text), F.lit(groups)).alias("group"))
    if expire is not None:
        rows = rows.withWatermark("t", delay)
    rows = rows.withColumn("us", F.unix_micros("t"))
    schema = ("id long, key string, us long, v double, " + ", ".join(f"{c} double" for c in names) + ", late_dropped long")
    expire_us = None if expire is None else _micros(expire)
    out = rows.groupBy("group").transformWithStateInPandas(
        lag_processor(names, list(lags), list(windows), expire_us, chunk_rows, bucket_us),
        schema, "Append", "None" if expire is None else "EventTime")
    at = F.timestamp_micros("us")
    back = F.unhex("key") if kind == "binary" else F.col("key").cast(kind)
    return out.select(F.col("id").alias(id_col), back.alias(key),
                      (instant_to_ntz(at) if stream.schema[time].dataType.simpleString() == "timestamp_ntz" else at).alias(time),
                      F.col("v").alias(value), *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in names], "late_dropped")
