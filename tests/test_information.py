"""Maximal information against a search of all grids, and on known relations."""

import itertools
import math
from collections import Counter

import numpy as np
import pytest

import plumbline as pl
from plumbline.operators.information import grid_size


def frame(spark, *columns):
    names = ["y", "x", "z"][: len(columns)]
    rows = [tuple(None if v is None else float(v) for v in r) for r in zip(*columns)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))


def information(a, b):
    n, ca, cb, both = len(a), Counter(a), Counter(b), Counter(zip(a, b))
    return sum(k / n * math.log(k * n / (ca[i] * cb[j])) for (i, j), k in both.items())


def even(values, q):
    """Bins of about equal counts; each distinct value goes by the middle of its rows."""
    count, below, place = Counter(values), 0, {}
    if len(count) <= q:
        return [sorted(count).index(v) for v in values]
    for v in sorted(count):
        place[v] = int((below + count[v] / 2) / len(values) * q)
        below += count[v]
    return [place[v] for v in values]


def brute(x, y, size):
    best = 0.0
    for fixed, free in ((y, x), (x, y)):
        own = sorted(set(free))
        for q in range(2, size // 2 + 1):
            rows = even(fixed, q)
            if len(set(rows)) < 2:
                continue
            for p in range(2, size // q + 1):
                for cuts in itertools.combinations(own[1:], p - 1):
                    columns = [sum(v >= c for c in cuts) for v in free]
                    best = max(best, information(rows, columns) / math.log(min(p, len(set(rows)))))
    return best


@pytest.mark.parametrize("seed", range(4))
def test_equals_a_search_of_all_grids(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 40 if seed % 2 else 9, 26)
    y = [(v - 15) ** 2 + int(e) for v, e in zip(x.tolist(), rng.integers(0, 90, 26))]
    power = 0.7
    found = pl.maximal_information(frame(spark, y, x), ["x"], "y", power, fineness=40).first()
    assert found["score"] == pytest.approx(brute(x.tolist(), y, grid_size(26, power)))
    assert found["n"] == 26 and found["bins_x"] * found["bins_y"] <= grid_size(26, power)


def test_relations_score_high_and_noise_low(spark):
    rng = np.random.default_rng(7)
    x = rng.uniform(-1, 1, 4000)
    df = frame(spark, np.cos(9 * x), x, rng.uniform(size=4000))
    found = {r["variable"]: r["score"] for r in pl.maximal_information(df, ["x", "z", "y"], "y", 0.5).collect()}
    assert found["y"] == pytest.approx(1, abs=1e-3) and found["x"] > 0.95 and found["z"] < 0.1
    spec = pl.TableSpec("y", "numerical")
    assert pl.drop_uninformative(df, spec, power=0.5).columns == ["y", "x"]


def test_layout_does_not_matter(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=3000)
    df = frame(spark, x + rng.normal(size=3000), x)
    one, eight = (pl.maximal_information(df.repartition(k), ["x"], "y").first() for k in (1, 8))
    assert one == eight


def test_missing_constant_and_empty(spark):
    df = frame(spark, [1, 2, None, 4, 5, 6], [1, 2, 3, None, 5, 6], [7] * 6)
    found = {r["variable"]: r for r in pl.maximal_information(df, ["x", "z"], "y").collect()}
    assert found["x"]["n"] == 4 and found["x"]["score"] == 1.0
    assert (found["z"]["n"], found["z"]["score"], found["z"]["bins_x"]) == (5, 0.0, 1)
    none = pl.maximal_information(df.limit(0), ["x"], "y").first()
    assert none["n"] == 0 and none["score"] is None
