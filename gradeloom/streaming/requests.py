"""The request flow of a scoring service, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def request_states(df: DataFrame, key: str, body: str, order: list[str]) -> DataFrame:
    """Per request: 'accepted' (first of its key), 'repeat' (same body again, gets the stored result) or 'conflict'."""
    first = F.first(F.xxhash64(body)).over(Window.partitionBy(key).orderBy(*order))
    rn = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("state", F.when(rn == 1, "accepted").when(F.xxhash64(body) == first, "repeat").otherwise("conflict"))


def interval_stats(df: DataFrame, ts: str, kind: str, value: str, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts, mean, most and the nearest-lower p50 and p95 per tumbling interval and kind; idle intervals are absent. Works on
    streams (late rows up to `late`) and tables."""
    src = df.withWatermark(ts, late) if df.isStreaming else df
    values = F.sort_array(F.collect_list(value))  # in a stream, the values of an open interval are its state
    q = lambda p: F.get(values, F.floor(p * (F.size(values) - 1)).cast("int"))
    if not df.isStreaming:  # distinct values with their counts are ranked, no group is gathered
        from gradeloom.operators.metrics import nearest_lower

        slot = df.withColumn("start", F.window(ts, every)["start"])
        got = slot.groupBy("start", kind).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("most"))
        p = nearest_lower(slot, ["start", kind], value, [0.5, 0.95], ["p50", "p95"])
        same = F.col("start").eqNullSafe(F.col("_s")) & F.col(kind).eqNullSafe(F.col("_k"))
        return got.join(p.withColumnsRenamed({"start": "_s", kind: "_k"}), same, "left").drop("_s", "_k")
    got = src.groupBy(F.window(ts, every), kind).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.max(value).alias("most"), q(0.5).alias("p50"), q(0.95).alias("p95"))
    return got.select(F.col("window.start").alias("start"), kind, "n", "mean", "most", "p50", "p95")


#: Characters of a message by which lines are told apart, and that a line shows.
KEY_LENGTH, SHOWN_LENGTH = 120, 400


def throttled(df: DataFrame, ts: str, key: str, every: int = 3600) -> DataFrame:
    """The first line of each key per interval, with the number of lines held back since the last one of that key."""
    slot = F.floor(F.unix_timestamp(ts) / every).cast("long")
    per = df.withColumn("slot", slot).groupBy(key, "slot").agg(F.min(ts).alias("first_at"), F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy(key).orderBy("slot"))
    return per.select(key, "first_at", F.coalesce(before - 1, F.lit(0)).alias("held_back"))


def stream_throttled(errors: DataFrame, status: str, message: str, ts: str, every: float = 60.0, late: str = "5 minutes") -> DataFrame:
    """A stream of error lines: one per status and message (its first KEY_LENGTH characters), then none for `every` seconds of
    event time; the next one tells how many were held back. Kept per key: when a line was written, and the number held back.
    State of a key goes when the watermark has passed it by an interval; what it held back then comes as a line of its own."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        line = lambda at, text, n: (k[0], text[:SHOWN_LENGTH], at, n)
        names = ["status", "message", "at", "held_back"]
        if state.hasTimedOut:
            last, held, text = state.get
            state.remove()
            if held:
                yield pd.DataFrame([line(pd.Timestamp(last, unit="us"), text, held)], columns=names)
            return
        last, held, text = state.get if state.exists else (None, 0, "")
        rows = pd.concat(list(batches)).sort_values(["at", "text"], kind="stable")
        out = []
        for at, said in zip(rows["at"], rows["text"]):
            us = at.value // 1000
            if last is not None and us - last < every * 1e6:
                held += 1
            else:
                out.append(line(at, said, held))
                last, held = us, 0
            text = said[:SHOWN_LENGTH]
        state.update((int(last), held, text))
        state.setTimeoutTimestamp(max(int(last // 1000 + every * 1000), state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=names)

    src = errors.select(F.col(status).cast("string").alias("status"), F.left(F.col(message), F.lit(KEY_LENGTH)).alias("key"), F.col(message).alias("text"), F.col(ts).alias("at")).withWatermark("at", late)
    return src.groupBy("status", "key").applyInPandasWithState(step, "status string, message string, at timestamp, held_back int", "last long, held int, text string", "append", GroupStateTimeout.EventTimeTimeout)


def stream_once(requests: DataFrame, key: str, body: str, ts: str, late: str = "1 day") -> DataFrame:
    """A stream of requests with their state, by arbitrary state per key: the hash of the earliest body (by event time, then by
    hash, whatever the order in a batch) is kept; it is dropped when the watermark, which lags by `late`, has passed it by the
    same span again, so state stays bounded."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    keep = int(pd.Timedelta(late).total_seconds() * 1000)

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches)).sort_values(["at", "body"], kind="stable")
        held, last = state.get if state.exists else (None, 0)
        first = held is None
        held = int(rows["body"].iloc[0]) if first else held
        states = ["repeat" if b == held else "conflict" for b in rows["body"]]
        if first:
            states[0] = "accepted"
        last = max(last, int(rows["at"].max().value // 1_000_000))
        state.update((held, last))
        state.setTimeoutTimestamp(max(last + keep, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"request": [k[0]] * len(states), "state": states})

    src = requests.select(F.col(key).cast("string").alias("request"), F.xxhash64(body).alias("body"), F.col(ts).alias("at")).withWatermark("at", late)
    return src.groupBy("request").applyInPandasWithState(step, "request string, state string", "held long, last long", "append", GroupStateTimeout.EventTimeTimeout)
