"""Streams of fixes: readouts, headings with memory, sessions split by gaps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def readout(fixes: DataFrame) -> DataFrame:
    """kmh and altitude as shown: a missing field is a dash, never the value before."""
    show = lambda x, unit: F.coalesce(F.concat(F.round(x).cast("long").cast("string"), F.lit(unit)), F.lit("–"))
    return fixes.withColumn("kmh", show(F.col("speed") * 3.6, " km/h")).withColumn("altitude_shown", show(F.col("altitude"), " m"))


def smoothed_headings(headings: Column, factor: float = 0.2) -> Column:
    """The state after an array of headings, each moving it by `factor` of the shorter way round."""
    turn = lambda s, h: F.pmod(h - s + 540, F.lit(360.0)) - 180
    return F.aggregate(headings, F.lit(None).cast("double"), lambda s, h: F.when(s.isNull(), F.pmod(h, F.lit(360.0))).otherwise(F.pmod(s + turn(s, h) * factor, F.lit(360.0))))


def heading_stream(fixes: DataFrame, device: str = "device", factor: float = 0.2) -> DataFrame:
    """(device, heading) after each batch, with the state kept by device over the stream."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def move(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get[0] if state.exists else None
        for pdf in batches:
            for h in pdf.sort_values("ts").heading:
                now = h % 360 if now is None else (now + ((h - now + 540) % 360 - 180) * factor) % 360
        state.update((now,))
        yield pd.DataFrame({device: [key[0]], "heading": [now]})

    kind = dict(fixes.dtypes)[device]
    return fixes.groupBy(device).applyInPandasWithState(move, f"{device} {kind}, heading double", "heading double", "update", GroupStateTimeout.NoTimeout)


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour", user: str = "user_id", ts: str = "ts") -> DataFrame:
    """(user, start, end, n) of sessions that a gap ends; on a stream late events are waited for as long as `late`."""
    marked = events.withWatermark(ts, late) if events.isStreaming else events
    got = marked.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n"))
    return got.select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
