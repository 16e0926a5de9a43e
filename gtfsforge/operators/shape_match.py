"""Distances along shapes, and stops matched to them (N-21, N-39).

Shape points get the distance travelled from the first one on.  The stops of a pattern are
projected onto the segments of its shape and matched in order: each stop takes a segment at or after the
one of the stop before it, such that the squares of the distances from the line sum up to the least.
A shape and its pattern's stops are one group (bounded by the length of a route); Spark deals the
groups out, a few numpy lines match one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cols import null_of
from ..functions.geo import EARTH, great_circle_m
from ..session import ship_package


def shape_distances(shapes: DataFrame) -> DataFrame:
    """The shape points with ``shape_dist_traveled`` (metres along the great circles between them).
    Points that share a sequence number (rank) follow by latitude and longitude."""
    w = Window.partitionBy("shape_id").orderBy("shape_pt_sequence", "shape_pt_lat", "shape_pt_lon")
    leg = great_circle_m(F.lag("shape_pt_lat").over(w), F.lag("shape_pt_lon").over(w), "shape_pt_lat", "shape_pt_lon")
    legs = shapes.withColumn("__leg", F.coalesce(leg, F.lit(0.0)))
    return legs.withColumn("shape_dist_traveled", F.sum("__leg").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__leg")


def match_in_order(points: np.ndarray, cum: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distance along the line, distance from it) of stops in order; points, stops: (lat, lon) in
    degrees, cum: metres travelled at each point.

    The cheapest way to a stop on a segment comes from the cheapest way to the stop before on that
    or an earlier segment, a running minimum.  A stop that would lie before its predecessor on one
    segment shares its place."""
    scale = np.array([EARTH, EARTH * np.cos(np.radians(points[0, 0]))])
    p, q = np.radians(points) * scale, np.radians(stops) * scale
    if len(p) == 1:
        return np.zeros(len(q)), np.hypot(*(q - p[0]).T)
    a, d = p[:-1], p[1:] - p[:-1]
    size = (d * d).sum(axis=1)
    t = np.clip(((q[:, None] - a) * d).sum(axis=2) / np.where(size > 0, size, 1), 0, 1)
    off = np.sqrt((((a + t[:, :, None] * d) - q[:, None]) ** 2).sum(axis=2))
    cost, came = off ** 2, np.zeros(off.shape, np.int64)
    for i in range(1, len(q)):
        best = np.minimum.accumulate(cost[i - 1])
        first = np.concatenate(([True], cost[i - 1][1:] < best[:-1]))
        came[i] = np.maximum.accumulate(np.where(first, np.arange(len(best)), 0))
        cost[i] += best
    at = np.zeros(len(q), np.int64)
    at[-1] = cost[-1].argmin()
    for i in range(len(q) - 1, 0, -1):
        at[i - 1] = came[i, at[i]]
    k = np.arange(len(q))
    along = cum[at] + t[k, at] * (cum[at + 1] - cum[at])
    return np.maximum.accumulate(along), off[k, at]


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Patterns (shape_id, stops, points) -> a row per stop."""
    for batch in batches:
        ids, stops, points = batch.columns
        s, p = stops.flatten(), points.flatten()
        n_stops, n_points = (pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False) for c in (stops, points))
        numbers = lambda rows, *names: np.column_stack([rows.field(c).to_numpy(zero_copy_only=False).astype(float) for c in names])
        places, where, dist = numbers(s, "lat", "lon"), numbers(p, "lat", "lon"), numbers(p, "dist")[:, 0]
        known, out = ~np.isnan(places).any(axis=1), np.full(places.shape, np.nan)
        i = j = 0
        for m, n in zip(n_stops, n_points):
            at = i + np.flatnonzero(known[i:i + m])
            if n and len(at):
                out[at] = np.column_stack(match_in_order(where[j:j + n], dist[j:j + n], places[at]))
            i, j = i + m, j + n
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.repeat(np.arange(len(batch)), n_stops))), s.field("stop_sequence"),
                                          *(pa.array(out[:, k], mask=np.isnan(out[:, k])) for k in (0, 1))], names=["shape_id", "stop_sequence", "shape_dist_traveled", "off_m"])


def stops_along_shapes(pattern_stops: DataFrame, shapes: DataFrame, off_m: float = 100.0) -> DataFrame:
    """(shape_id, stop_sequence, shape_dist_traveled, off_m, off_line) per stop of a pattern.

    ``pattern_stops``: (shape_id, stop_sequence, stop_lat, stop_lon); ``shapes`` as exported.  Stops farther than
    ``off_m`` from where they are matched are off the line.  A stop without position, and the stops of a pattern
    without shape, have NULLs; a shape without stops has no row."""
    ship_package(shapes.sparkSession)
    own = pattern_stops.select("shape_id", "stop_sequence", F.col("stop_lat").cast("double").alias("lat"), F.col("stop_lon").cast("double").alias("lon"))
    line = shape_distances(shapes).select("shape_id", F.col("shape_pt_sequence").alias("seq"), F.col("shape_pt_lat").cast("double").alias("lat"),
                                          F.col("shape_pt_lon").cast("double").alias("lon"), F.col("shape_dist_traveled").alias("dist"))

    # a row per pattern, with its stops and its line as lists in order: a batch holds many patterns
    calls = own.groupBy("shape_id").agg(F.array_sort(F.collect_list(F.struct(F.col("stop_sequence").isNull().alias("late"), "stop_sequence", "lat", "lon"))).alias("stops"))
    points = line.dropna().groupBy("shape_id").agg(F.array_sort(F.collect_list(F.struct("seq", "lat", "lon", "dist"))).alias("points"))
    made = calls.join(points.hint("merge"), "shape_id", "left").select("shape_id", "stops", "points").mapInArrow(
        _matched, own.select("shape_id", "stop_sequence", null_of("double").alias("shape_dist_traveled"), null_of("double").alias("off_m")).schema)
    return made.withColumn("off_line", F.col("off_m") > off_m)
