"""Intervals in time: islands, bounded merges, overlaps, differences, splits."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = "array<struct<a: double, b: double>>"


def gap_islands(df: DataFrame, keys: list[str], start: str, end: str, gap: float) -> DataFrame:
    """Intervals of a key joined where the next starts less than ``gap`` after the furthest end so far."""
    before = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(end).over(before)
    fresh = F.when(F.col(start) - reached < gap, 0).otherwise(1)
    order = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_fresh", fresh).withColumn("island", F.sum("_fresh").over(order))
    return rows.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("parts"))


def bounded_segments(df: DataFrame, key: str, max_gap: float = 0.6, longest: float = 15.0, shortest: float = 1.0) -> DataFrame:
    """Consecutive cues of a key joined while the gap and the joined length allow; short segments go.

    Whether a cue joins depends on where its segment began, so each key is folded in order, one segment at a time.
    """
    kind = df.schema[key].dataType.simpleString()

    def fold(batches):
        now, segment = None, None
        for rows in batches:
            done = []
            for k, s, e, t in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if segment is not None and k == now and s - segment[1] <= max_gap and e - segment[0] <= longest:
                    segment[1:] = [e, f"{segment[2]} {t}"]
                    continue
                if segment is not None and segment[1] - segment[0] >= shortest:
                    done.append((now, *segment))
                now, segment = k, [s, e, t]
            yield made(done, rows.schema)
        if segment is not None and segment[1] - segment[0] >= shortest:
            yield made([(now, *segment)], rows.schema)

    def made(done, schema):
        columns = zip(*done, strict=True) if done else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names=[key, "start", "end", "text"])

    rows = df.select(key, F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"), "text").repartition(key).sortWithinPartitions(key, "start", "end")
    return rows.mapInArrow(fold, f"`{key}` {kind}, start double, end double, text string")


def overlaps(df: DataFrame, keys: list[str], speaker: str, start: str, end: str) -> DataFrame:
    """Maximal spans in which two or more speakers of a key are active: a sweep over starts and ends.

    A speaker's own intervals are united first, so a speaker counts once; at one instant ends come before starts.
    """
    alone = gap_islands(df, [*keys, speaker], start, end, 1e-12)
    events = alone.select(*keys, F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("d")), F.struct(F.col(end).alias("t"), F.lit(-1).alias("d")))).alias("e")).select(*keys, "e.*")
    w = Window.partitionBy(*keys).orderBy("t", "d")
    steps = events.withColumn("active", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("until", F.lead("t").over(w))
    busy = steps.where("active >= 2 and until > t").select(*keys, F.col("t").alias(start), F.col("until").alias(end))
    return gap_islands(busy, keys, start, end, 1e-12).select(*keys, start, end)


def difference(a: Column, b: Column, holes: Column) -> Column:
    """Pieces of the span a..b outside the holes (array of ``a``, ``b``), as an array."""
    whole = F.array(F.struct(a.cast("double").alias("a"), b.cast("double").alias("b")))

    def cut(pieces: Column, hole: Column) -> Column:
        def of(p: Column) -> Column:
            left = F.when(hole["a"] > p["a"], F.struct(p["a"].alias("a"), hole["a"].alias("b")))
            right = F.when(hole["b"] < p["b"], F.struct(hole["b"].alias("a"), p["b"].alias("b")))
            apart = (hole["b"] <= p["a"]) | (hole["a"] >= p["b"])
            return F.when(apart, F.array(p)).otherwise(F.filter(F.array(left, right), lambda x: x.isNotNull()))

        return F.flatten(F.transform(pieces, of))

    return F.aggregate(holes, whole.cast(SPAN), lambda acc, h: cut(acc, h).cast(SPAN))


def equal_parts(start: Column, end: Column, longest: float) -> Column:
    """A span cut into the fewest equal parts that are short enough."""
    n = F.greatest(F.lit(1), F.ceil((end - start) / longest)).cast("int")
    step = (end - start) / n
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((start + i * step).alias("a"), (start + (i + 1) * step).alias("b")))


def tumbling_chunks(total: Column, size: float) -> Column:
    """Chunks of a length (start, length); a short tail joins the last one."""
    least = min(60.0, size / 4)
    n = F.floor(total / size).cast("int")
    tail = total - n * size
    joined = (n > 0) & (tail < least)
    count = F.when(total <= 0, 0).when(joined, n).otherwise(n + F.when(tail > 0, 1).otherwise(0))
    make = lambda i: F.struct((i * F.lit(float(size))).alias("start"), F.when(i < count - 1, F.lit(float(size))).otherwise(total - i * size).alias("length"))
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), make)).otherwise(F.array().cast("array<struct<start: double, length: double>>"))


def frame_segments(frames: DataFrame, keys: list[str], frame: str, active: Column, seconds: float, min_gap: float = 0.2, min_on: float = 0.25, offset: float = 0.0) -> DataFrame:
    """Runs of active frames as segments; short gaps are bridged, then short runs dropped."""
    on = frames.where(active).select(*keys, (F.col(frame) * seconds).alias("start"), ((F.col(frame) + 1) * seconds).alias("end"))
    # frames beside each other touch, so one pass of islands joins them and bridges gaps shorter than min_gap
    joined = gap_islands(on.withColumns({"start": F.round("start", 9), "end": F.round("end", 9)}), keys, "start", "end", max(min_gap, 1e-9))
    long_enough = joined.where(F.round(F.col("end") - F.col("start"), 9) >= min_on)
    return long_enough.select(*keys, F.round(F.col("start") + offset, 3).alias("start"), F.round(F.col("end") + offset, 3).alias("end"))


def failure_streaks(df: DataFrame, keys: list[str], order: list[str], outcome: str, trip: int = 4) -> DataFrame:
    """``streak``: failures in a row so far; a success ends it, other outcomes change nothing. ``tripped`` from ``trip`` on."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_run", F.sum(F.when(F.col(outcome) == "ok", 1).otherwise(0)).over(w))
    in_run = Window.partitionBy(*keys, "_run").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    streak = F.sum(F.when(F.col(outcome) == "failed", 1).otherwise(0)).over(in_run)
    rows = rows.withColumn("streak", streak)
    return rows.withColumn("tripped", F.max((F.col("streak") >= trip).cast("int")).over(w) == 1).drop("_run")
