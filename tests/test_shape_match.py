"""Stops matched to shapes, against trying all ways."""

import itertools
import math
import random

import numpy as np
import pytest

from gtfsforge.functions.geo import EARTH
from gtfsforge.operators import shape_match as S
from gtfsforge.plans import q_kv1

from conftest import SF_SMALL


def _brute(points, cum, stops):
    """The least sum of squares over all ways that do not go back."""
    scale = (EARTH, EARTH * math.cos(math.radians(points[0][0])))
    flat = lambda p: tuple(math.radians(v) * s for v, s in zip(p, scale))
    p, q = [flat(x) for x in points], [flat(x) for x in stops]

    def off(stop, k):
        (ax, ay), (bx, by) = p[k], p[k + 1]
        size = (bx - ax) ** 2 + (by - ay) ** 2
        t = min(1, max(0, ((stop[0] - ax) * (bx - ax) + (stop[1] - ay) * (by - ay)) / size)) if size else 0
        return math.hypot(ax + t * (bx - ax) - stop[0], ay + t * (by - ay) - stop[1]), cum[k] + t * (cum[k + 1] - cum[k])

    ways = itertools.combinations_with_replacement(range(len(p) - 1), len(q))
    return min((sum(off(s, k)[0] ** 2 for s, k in zip(q, way)), [off(s, k)[0] for s, k in zip(q, way)]) for way in ways)


@pytest.mark.parametrize("seed", range(12))
def test_the_match_is_the_best_that_keeps_the_order(seed):
    rnd = random.Random(seed)
    points = [(52 + rnd.random() / 100, 5 + rnd.random() / 100) for _ in range(rnd.randrange(2, 8))]
    if seed % 3 == 0:
        points += points[::-1]  # there and back on the same road
    cum = np.concatenate(([0.0], np.cumsum([1.0 + rnd.random() for _ in points[1:]])))
    stops = [(52 + rnd.random() / 100, 5 + rnd.random() / 100) for _ in range(rnd.randrange(1, 5))]
    along, off = S.match_in_order(np.array(points), cum, np.array(stops))
    best, _ = _brute(points, cum, stops)
    assert (off ** 2).sum() == pytest.approx(best) and (np.diff(along) >= 0).all()


def test_there_and_back(spark):
    road = [(52.0, 5.0 + k / 1000) for k in range(5)]
    shape = [("s", a, b, k) for k, (a, b) in enumerate([*road, *road[-2::-1]])] + [("dot", 52.0, 5.0, 1), ("unused", 52.0, 5.0, 1)]
    shapes = spark.createDataFrame(shape, "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int")
    stops = [("s", 1, 52.0, 5.0), ("s", 2, 52.0001, 5.002), ("s", 3, 52.0, 5.004), ("s", 4, 52.0, 5.002), ("s", 5, 52.0, 5.0), ("s", 6, None, 5.0), ("dot", 1, 52.01, 5.0), ("none", 1, 52.0, 5.0)]
    df = spark.createDataFrame(stops, "shape_id string, stop_sequence int, stop_lat double, stop_lon double")
    got = {(r["shape_id"], r["stop_sequence"]): (r["shape_dist_traveled"], r["off_m"], r["off_line"]) for r in S.stops_along_shapes(df, shapes).collect()}
    unit = EARTH * math.radians(0.001) * math.cos(math.radians(52))
    along = [got["s", k][0] / unit for k in range(1, 6)]
    assert along == pytest.approx([0, 2, 4, 6, 8], abs=1e-3)
    assert got["s", 2][1] == pytest.approx(11.12, abs=0.01) and got["s", 2][2] is False
    assert got["s", 6] == (None, None, None) and got["none", 1] == (None, None, None) and len(got) == 8
    assert got["dot", 1][0] == 0 and got["dot", 1][2] is True
    assert S.stops_along_shapes(df.limit(0), shapes).count() == 0


def test_every_stop_of_the_fixtures_is_matched_in_order(spark):
    rows = q_kv1.q_stops_along_shapes(spark, SF_SMALL).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shape_id"], []).append((r["stop_sequence"], r["shape_dist_traveled"]))
    assert len(by) > 100
    for v in by.values():
        along = [d for _, d in sorted(v) if d is not None]
        assert along == sorted(along)
