"""Most frequent values from bounded summaries."""

from collections import Counter

import numpy as np
import pytest

import plumbline as pl
from plumbline.operators import frequent


def expected(columns, k):
    out = set()
    for name, values in columns.items():
        counts = Counter(v for v in values if v is not None)
        ranked = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]
        out |= {(name, v, n, i) for i, (v, n) in enumerate(ranked, 1)}
    return out


@pytest.fixture
def columns():
    rng = np.random.default_rng(2)
    n = 6000
    skewed = np.where(rng.uniform(size=n) < 0.5, rng.integers(0, 4, n), rng.integers(0, 3000, n))
    return {
        "skewed": [f"s{v}" for v in skewed],
        "flat": [f"f{i % 4500}" for i in range(n)],
        "few": [None if v == 0 else "abc"[v - 1] for v in rng.integers(0, 4, n)],
        "none": [None] * n,
    }


@pytest.mark.parametrize("chunk", [200, 1 << 17])
def test_ranks_are_exact_whatever_the_summary_holds(spark, columns, monkeypatch, chunk):
    monkeypatch.setattr(frequent, "COUNTERS", 40)
    monkeypatch.setattr(frequent, "CHUNK_ROWS", chunk)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} string" for c in columns)).repartition(3)
    found = pl.top_values(df, list(columns), 4)
    assert {tuple(r) for r in found.collect()} == expected(columns, 4)


def test_skewed_column_is_settled_by_its_summary(spark, columns, monkeypatch):
    monkeypatch.setattr(frequent, "COUNTERS", 400)
    df = spark.createDataFrame([(v,) for v in columns["skewed"]], "skewed string").repartition(2)
    counted = frequent.frequent_values(df, ["skewed"], 4)
    assert 4 <= counted.count() < 100  # not all 3000 values
    assert {tuple(r) for r in pl.top_values(df, ["skewed"], 4).collect()} == expected({"skewed": columns["skewed"]}, 4)


def test_empty_table_and_more_places_than_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    assert [tuple(r) for r in pl.top_values(df, ["c"], 9).orderBy("rank").collect()] == [("c", "a", 2, 1), ("c", "b", 1, 2)]
    assert pl.top_values(df.limit(0), ["c"], 3).count() == 0
