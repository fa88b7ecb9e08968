"""Vector search, filter audit and lexical search against brute force, and on odd input."""

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import audit, lexical, merging, terms, vectors
from plumbline.llm.common import Scratch

CLASHES = ("row", "shard", "block", "node", "top", "dim", "v", "q", "part", "mask", "digest", "n", "words")


def clashing(df):
    return df.withColumns({c: F.lit("other") for c in CLASHES if c not in df.columns})


# ---- vectors ----

VECTORS = [
    (0, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, [0.5, -0.25, 1.0]), (3, [-1.0, 0.01, 0.3]),
    (4, [0.0, 0.0, 0.0]), (5, []), (6, None), (7, [1.0, None, 2.0]), (8, [float("nan"), 1.0, 1.0]),
    (9, [float("inf"), 1.0, 1.0]), (10, [2.0]), (11, [1.0, 1.0, 1.0, 1.0]), (20, [0.7, 0.7, 0.7]),
    (20, [0.7, 0.7, 0.7]), (20, [-0.7, 0.1, 0.2]), (None, [0.5, -0.25, 1.0]), (40, None),
]


def brute_top(rows, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    found = []
    for a, (i, x) in enumerate(ok):
        if i is None or i % 20:
            continue
        scored = []
        for b, (j, y) in enumerate(ok):
            if a != b:
                s = sum(p * q for p, q in zip(x, y))
                scored.append((-max(-vectors.LARGEST, min(vectors.LARGEST, s)), -1 if j is None else j))
        found += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return sorted(found)


def top(df, k, **more):
    rows = vectors.exact_top_k(df, F.col("vec_id") % 20 == 0, k, **more).collect()
    return sorted((r.query_id, r.rank, -1 if r.vec_id is None else r.vec_id, r.score) for r in rows)


@pytest.mark.parametrize("k", [1, 4, 50])
def test_top_k_odd_rows(spark, k):
    df = clashing(spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>").repartition(3))
    assert top(df, k) == brute_top(VECTORS, k)


def test_top_k_tiles_and_ties(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.3, 0.9]) for _ in range(4)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    exact = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert top(df, 7, tile_queries=4, tile_rows=20) == brute_top(exact, 7)


@pytest.mark.parametrize("size", [1e3, 1e8, 1e12, 1e300])
def test_top_k_is_exact_for_large_numbers(spark, size):
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-size, size) for _ in range(3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert top(df, 5) == brute_top(rows, 5)


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got = vectors.exact_top_k(df, F.col("vec_id") % 20 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0


def test_merge_tops_in_rounds(spark):
    rows = [(q, node, [(-((7 * node + q) % 101), node)]) for q in range(3) for node in range(700)]
    lists = spark.createDataFrame(rows, "q int, node long, top array<struct<less: long, id: long>>")
    got = {r.q: [tuple(x) for x in r.top] for r in merging.merge_tops(lists, ["q"], 9, 700).collect()}
    assert got == {q: sorted(t[0] for a, _, t in rows if a == q)[:9] for q in range(3)}


# ---- matrix ----

WORDED = [
    (1, None), (2, ""), (3, "a b a"), (3, "a b a"), (None, "b\tb\nc"), (7, "x" * 50_000), (8, "w " * 40_000),
    (9, "é x é x y \x0b\x0c"),
]
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("cells", [1, 3, 1 << 20])
def test_matrix_holds_every_cell(spark, cells):
    df = spark.createDataFrame(WORDED, "doc_id long, text string").repartition(2)
    rows = df.withColumn("text", F.coalesce("text", F.lit("")))
    with Scratch(spark) as scratch:
        shards = scratch.stage(terms.term_shards(rows, bytes.split, cells=cells), "shards")
        words = terms.numbered_words(shards, scratch)
        name = {r.term_id: bytes(r.word).decode() for r in terms.dictionary(words).collect()}
        matrix = terms.global_shards(shards, words).collect()
        sums = sorted(map(tuple, terms.row_sums(terms.global_shards(shards, words)).collect()), key=str)
    assert sorted(name) == list(range(len(name))) and len(set(name.values())) == len(name)
    got = []
    for shard in matrix:
        ends, ids, counts = (terms.unpacked(bytes(shard[c])) for c in ("ends", "ids", "counts"))
        for doc, start, end in zip(shard.docs, [0, *ends], ends):
            cells = zip(ids[start:end], counts[start:end])
            got.append((doc.doc_id, sorted((name[i], int(c)) for i, c in cells)))
    want = [(i, Counter(SPLIT.findall(t or ""))) for i, t in WORDED]
    assert sorted(got, key=str) == sorted(((i, sorted(c.items())) for i, c in want), key=str)
    assert sums == sorted(((i, sum(c.values()), len(c)) for i, c in want), key=str)


def test_packed_numbers():
    for numbers in ([], [0], [255], [256, 1], [1 << 20], [1 << 40]):
        assert list(terms.unpacked(terms.packed(numbers))) == numbers


# ---- audit ----

FILLER = [f"w{i}" for i in range(120)]
AUDITED = [
    (1, None, "en"), (2, "", None), (3, "", ""), (4, "short text", "en"), (5, "short text", "de"),
    (5, "short text", "en"), (6, " ".join(FILLER), "en"), (7, " ".join(FILLER), "en"),
    (8, " ".join(FILLER[:50] * 3), "de"), (9, "A" * 30 + " b" * 100, "de"), (10, " ".join(FILLER) + " #", "fr"),
    (None, " ".join(FILLER), "fr"), (11, "ÄÖÜ" * 20 + "ABCDEFG", "fr"), (12, "x " * 40_000, "en"),
    (13, "A" * 10 + "é" * 90, "en"), (14, "A" * 11 + "é" * 89, "en"), (15, " ".join(FILLER[:100]), "en"),
]
LABELS = [(4, 1, 0), (5, 1, 1), (7, 1, None), (7, None, 1), (8, 0, 1), (9, None, None), (None, 1, 1), (99, 1, 1)]


def brute_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    failing = []
    for i, t, part in docs:
        t = t or ""
        w = SPLIT.findall(t)
        fails = set()
        fails |= {"A"} if len(w) < 100 else set()
        fails |= {"B"} if 100 * len(set(w)) < 80 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 10 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if i is not None and first[t] < i else set()
        failing.append((part or "", fails, i in good, i in toxic))
    rows = []
    for part in {p for p, *_ in failing}:
        mine = [x for x in failing if x[0] == part]
        orders = ["".join(p) for p in permutations("ABCDE")]
        removed_in = Counter()
        found = []
        for order in orders:
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                here = [x for x in mine if letter in x[1] and not x[1] & before]
                removed_in[letter] += len(here)
                found.append((
                    part, order, step, sum(not x[1] & {*before, letter} for x in mine), len(here),
                    sum(letter in x[1] and bool(x[1] & before) for x in mine), sum(x[1] == {letter} for x in mine),
                    sum(x[2] for x in here), sum(x[3] for x in here),
                ))
        rows += [(*r, removed_in[r[1][r[2] - 1]]) for r in found]
    return sorted(rows)


def test_audit_odd_rows(spark):
    df = spark.createDataFrame(AUDITED, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("lang", F.lit("x"))
    got = audit.filter_audit(clashing(df), clashing(labels))
    assert got.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley",
    ]
    assert sorted(map(tuple, got.collect())) == brute_audit(AUDITED, LABELS)


def test_audit_without_labels_and_documents(spark):
    df = spark.createDataFrame(AUDITED, "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, audit.filter_audit(df, none).collect())) == brute_audit(AUDITED, [])
    assert audit.filter_audit(df.filter("false"), none).count() == 0


# ---- lexical search ----

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SEARCHED = [
    (1, None), (2, ""), (3, " ,.-!"), (4, "red Red RED fox"), (5, "red fox"), (5, "red fox"), (None, "red fox"),
    (6, "the quick-brown fox jumps"), (7, "x" * 30_000), (8, "fox " * 20_000), (9, "Éclair éclair 日本 red"),
    (10, "a_b c'd 1,2"), (11, "blue blue green"), (12, "green blue"),
]
ITEMS = [(1, "red fox"), (2, None), (3, ""), (4, "Éclair"), (5, "unknown"), (6, "blue GREEN blue"), (6, "fox fox"),
         (None, "brown, red; a 日本"), (8, "x" * 30_000), (9, "!!")]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_search(docs, items, k):
    counted = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    found = []
    for item, text in items:
        scored = []
        for i, c in counted:
            m = 10 + (90 * sum(c.values()) * n_docs) // max(1, n_terms)
            score = 0
            for w in set(TERM.findall(lowered(text))):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, -1 if i is None else i))
        found += [(str(item), r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(found)


def searched(spark, docs, items, k, **more):
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    queries = clashing(spark.createDataFrame(items, "item_id long, text string"))
    rows = lexical.ranked_search(df, queries, k, **more).collect()
    return sorted((str(r.item_id), r.rank, -1 if r.doc_id is None else r.doc_id, r.score) for r in rows)


@pytest.mark.parametrize("k,query_bytes", [(1, 1 << 20), (3, 1 << 20), (50, 100)])
def test_search_odd_rows(spark, k, query_bytes):
    assert searched(spark, SEARCHED, ITEMS, k, query_bytes=query_bytes) == brute_search(SEARCHED, ITEMS, k)


def test_search_prunes_without_loss(spark, monkeypatch):
    monkeypatch.setattr(lexical, "VISIT", 1)
    draw = random.Random(3)
    words = [f"t{i}" for i in range(60)]
    docs = [(i, " ".join(draw.choices(words, range(60, 0, -1), k=draw.randint(0, 300)))) for i in range(400)]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for i in range(25)]
    assert searched(spark, docs, items, 10) == brute_search(docs, items, 10)


def test_search_visits_strata_by_bound():
    """The bound of the strata left out is below the k-th score."""
    docs = [["a"] * t + ["z"] * n for n, t in ((1, 3), (400, 1), (800, 1), (2, 2), (900, 1))]
    lengths = np.array([len(d) for d in docs])
    m = lexical.normaliser(lengths, len(docs), int(lengths.sum()))
    assert (np.diff(m[np.argsort(lengths)]) >= 0).all()


def test_search_empty_tables(spark):
    assert searched(spark, [], ITEMS, 5) == []
    assert searched(spark, SEARCHED, [], 5) == []
    assert searched(spark, [(1, None), (2, "..")], ITEMS, 5) == []


QUERY_COLUMNS = {
    "op11_top_k_search": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op12_filter_audit": {
        "part": "string", "filter_order": "string", "step": "int",
        **dict.fromkeys(
            ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint"
        ),
    },
    "op13_lexical_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
}


@pytest.mark.parametrize("name", QUERY_COLUMNS)
def test_query_columns(spark, name):
    from plumbline.llm.queries import QUERIES

    assert dict(QUERIES[name](spark, "/root/testdata/sf0.001").dtypes) == QUERY_COLUMNS[name]


def test_large_rows_are_written_in_small_groups_and_read_one_by_one(spark):
    """A task's part of the index has as many shards as its documents ask for; it holds few at once."""
    import glob
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq
    from plumbline.llm.common import LARGE_ROWS, ROWS_PER_BATCH, Scratch, single_rows

    def sizes(source):
        for batch in source:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    rows = [(i, os.urandom(6 << 20)) for i in range(8)]
    with Scratch(spark) as scratch:
        table = scratch.stage(spark.createDataFrame(rows, "i int, data binary").coalesce(1), "large", LARGE_ROWS)
        (file,) = glob.glob(f"{scratch.paths[0].removeprefix('file:')}/*.parquet")
        assert pq.ParquetFile(file).num_row_groups >= 2
        before = spark.conf.get(ROWS_PER_BATCH)
        with single_rows(spark):
            assert {r["n"] for r in table.mapInArrow(sizes, "n long").collect()} == {1}
        assert spark.conf.get(ROWS_PER_BATCH) == before


def test_shards_of_the_search_hold_no_more_than_their_cells(spark, monkeypatch):
    from plumbline.llm import lexical
    from plumbline.llm.common import Scratch

    texts = [(i, " ".join(f"w{(i * 7 + j * j) % 97}" for j in range(40))) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    asked = spark.createDataFrame([(1, "w1 w5 w9"), (2, "w96 none w3")], "item_id long, text string")
    want = sorted(map(tuple, lexical.ranked_search(docs, asked).collect()))
    monkeypatch.setattr(lexical, "CELLS", 400)
    with Scratch(spark) as scratch:
        index = lexical.lexical_index(docs, scratch)
        assert index.shards.count() > 10
    assert sorted(map(tuple, lexical.ranked_search(docs, asked).collect())) == want and len(want) == 20
