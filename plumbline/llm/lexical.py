"""Ranked lexical search over a length-stratified index."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import attach, col, require
from .bpe import arrow_type
from .common import LARGE_ROWS, Scratch, ascii_lower, id_type, single_rows, stage, text_of, thin
from .merging import merge_tops, top_lists
from .terms import packed, term_shards, unpacked

#: What parts two terms: every ASCII character that is no letter or digit.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: Bytes of query terms that are sent to the tasks at once.
QUERY_BYTES = 4 << 20
#: Cells of a shard, which tasks hold, sort and search as a whole.
CELLS = 1 << 20
#: Strata that a search visits first; each later visit takes twice as many.
VISIT = 16
#: Fixed values of the score: shares of the length part, in percent, and scales.
LENGTH, ALL, K, ONE, WEIGHT = 90, 100, 8, 1_000_000_000, 1000


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case."""
    return text.translate(_FOLD).split()


@dataclass
class Index:
    """``shards``: a row of strata and postings per block of documents. ``n_docs`` have a
    term; ``n_terms`` counts all terms with repeats."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def normaliser(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``m`` of documents with so many terms, in whole numbers."""
    if n_docs * LENGTH * int(lengths.max(initial=0)) >= 1 << 63:
        lengths = lengths.astype(object)
    return (ALL - LENGTH + (LENGTH * lengths * n_docs) // max(1, n_terms)).astype("i8")


def _stratified(shard: dict, n_docs: int, n_terms: int) -> tuple:
    """The shard's postings by term, stratum, falling tf and document.

    A run is the documents of one term, stratum and tf.
    """
    ends, ids, tf = (unpacked(shard[c]) for c in ("ends", "ids", "counts"))
    sizes = np.diff(ends, prepend=0)
    sums = np.r_[0, np.cumsum(tf)]
    m, stratum = np.unique(
        normaliser(sums[ends] - sums[ends - sizes], n_docs, n_terms), return_inverse=True
    )
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((doc, -tf, stratum[doc], ids))
    ids, tf, doc = ids[order], tf[order], doc[order]
    of = stratum[doc]
    first = np.flatnonzero(
        np.r_[len(ids) > 0, (ids[1:] != ids[:-1]) | (of[1:] != of[:-1]) | (tf[1:] != tf[:-1])]
    )
    runs = np.searchsorted(ids[first], np.arange(shard["n_words"]), "right")
    parts = (m, runs, of[first], tf[first], np.diff(np.r_[first, len(ids)]), doc)
    return tuple(packed(x) for x in parts)


POSTINGS = ("m", "run_ends", "run_stratum", "run_tf", "run_size", "places")


def lexical_index(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The written index of all documents: ``shard, ids, words, holders`` and the postings.

    One pass counts the terms of every document in shards of bounded size; the
    normaliser needs the corpus' sums, so a second one groups each shard's
    documents by it and sorts the postings. No posting is shuffled. Tasks hold one shard,
    and writers a few, whatever the size of their part of the documents.
    """
    rows = thin(df, id_col, text_col)
    raw = scratch.stage(term_shards(rows, terms_of, cells=CELLS), "terms", LARGE_ROWS)

    def sums(source):
        for batch in source:
            docs = [np.count_nonzero(np.diff(unpacked(x.as_py()), prepend=0)) for x in batch["ends"]]
            terms = [int(unpacked(x.as_py()).sum()) for x in batch["counts"]]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(terms, pa.int64())], names=["docs", "terms"])

    total = raw.select("ends", "counts").mapInArrow(sums, "docs long, terms long")
    with single_rows(df.sparkSession):
        n_docs, n_terms = (x or 0 for x in total.agg(F.sum("docs"), F.sum("terms")).first())

    def strata(source):
        for batch in source:
            for i in range(batch.num_rows):
                shard = {c: batch[c][i].as_py() for c in ("ends", "ids", "counts", "n_words")}
                found = _stratified(shard, n_docs, n_terms)
                yield pa.RecordBatch.from_arrays(
                    [*[batch[c].slice(i, 1) for c in kept], *[pa.array([x], pa.binary()) for x in found]],
                    names=[*kept, *POSTINGS],
                )

    kept = ["shard", "docs", "words", "holders"]
    kind = id_type(rows, "doc_id").simpleString()
    index = raw.withColumn("n_words", F.size("words")).mapInArrow(
        strata,
        f"shard long, docs array<struct<doc_id: {kind}>>, words array<binary>, holders array<long>, "
        + ", ".join(f"{c} binary" for c in POSTINGS),
    )
    with single_rows(df.sparkSession):
        return Index(scratch.stage(index, "index", LARGE_ROWS), n_docs, n_terms)


def _weighted_queries(index: Index, queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``q, item_id, word, w``: the distinct terms of each query that a document holds."""
    require(queries, [id_col])
    parts = F.split(ascii_lower(text_of(queries, text_col)), SEPARATORS)
    wanted = queries.select(
        F.monotonically_increasing_id().alias("q"),
        col(id_col).alias("item_id"),
        F.array_distinct(F.filter(parts, lambda w: w != "")).cast("array<binary>").alias("words"),
    )
    wanted = wanted.select("q", "item_id", F.explode("words").alias("word"))
    own = index.shards.select(F.explode(F.arrays_zip("words", "holders")).alias("x"))
    own = own.select(F.col("x.words").alias("word"), F.col("x.holders").alias("holders"))
    asked = attach(own, wanted.select("word").distinct(), ["word"], "left_semi")
    df = asked.groupBy("word").agg(F.sum("holders").alias("df"))
    rarity = F.lit(2.0 * index.n_docs + 2.0) / (2.0 * F.col("df") + 1.0)
    w = F.floor(F.lit(float(WEIGHT)) * F.log(rarity)).cast("long")
    return wanted.join(df, "word").select("q", "item_id", "word", w.alias("w"))


class _Shard:
    """One shard's postings, read for the words of a block of queries."""

    def __init__(self, row: dict, words: pa.Array, asked: set[bytes], rank: np.ndarray):
        self.m, ends, self.stratum, self.tf, self.size, self.places = (unpacked(row[c]) for c in POSTINGS)
        self.starts = np.r_[0, np.cumsum(self.size)]
        self.ends = np.r_[0, ends]
        self.number = {w: i for i, w in enumerate(words.to_pylist()) if w in asked}
        self.rank = rank
        self.score = np.zeros(len(rank), "i8")
        self.known: dict[int, tuple] = {}

    def runs(self, word: int) -> tuple:
        """Of a word: its runs, the impact of each and which are the first of their stratum.

        The impact depends on tf and the stratum alone and is computed once for all
        documents and queries.
        """
        if word not in self.known:
            runs = np.arange(self.ends[word], self.ends[word + 1])
            stratum, tf = self.stratum[runs], self.tf[runs]
            impact = (ONE * tf) // (1000 * tf + K * self.m[stratum])
            self.known[word] = runs, impact, np.r_[True, stratum[1:] != stratum[:-1]]
        return self.known[word]

    def best(self, terms: list[tuple[bytes, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and places of the shard's ``k`` best, most first.

        A stratum's bound adds up the largest impact of each term in it. Strata are
        visited by falling bound until it is below the k-th score.
        """
        held = [(self.runs(self.number[word]), w) for word, w in terms if word in self.number]
        if not held:
            return np.empty(0, "i8"), np.empty(0, "i8")
        bound = np.zeros(len(self.m), "i8")
        for (runs, impact, first), w in held:
            bound[self.stratum[runs[first]]] += w * impact[first]
        visits = np.argsort(-bound, kind="stable")
        turn = np.empty(len(visits), "i8")
        turn[visits] = np.arange(len(visits))
        runs = np.concatenate([x[0] for x, _ in held])
        gain = np.concatenate([w * x[1] for x, w in held])
        order = np.argsort(turn[self.stratum[runs]], kind="stable")
        runs, gain = runs[order], gain[order]
        turns = turn[self.stratum[runs]]
        scores, places = np.empty(0, "i8"), np.empty(0, "i8")
        done, step = 0, VISIT
        while done < len(visits):
            most = bound[visits[done]]
            if most == 0 or (len(scores) == k and most < scores[-1]):
                break
            here = slice(*np.searchsorted(turns, (done, done + step)))
            size = self.size[runs[here]]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            found = self.places[np.repeat(self.starts[runs[here]], size) + inside]
            np.add.at(self.score, found, np.repeat(gain[here], size))
            found = found[self.score[found] > 0]
            # each place once, and its score cleared for the next visit
            found = np.unique(found)
            scores = np.r_[scores, self.score[found]]
            places = np.r_[places, found]
            self.score[found] = 0
            if len(scores) > k:
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                scores, places = scores[scores >= least], places[scores >= least]
            order = np.lexsort((self.rank[places], -scores))[:k]
            scores, places = scores[order], places[order]
            done, step = done + step, 2 * step
        return scores, places


def ranked_search(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents for each row of ``queries``.

    Terms are runs of letters, digits and non-ASCII characters, A-Z in lower case.
    With N documents that have a term, L terms in all, n terms in a document, df documents
    with a term and tf occurrences, a document's m is ``10 + 90 * n * N div L``, a term's
    weight w is ``floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and the score adds up
    ``w * (1000000000 * tf div (1000 * tf + 8 * m))`` over the query's distinct terms.
    Scores above 0 count, equal ones by ascending ``doc_id``, a null one first.

    Null texts have no terms. Repeated rows are documents, or queries, of
    their own. Queries without a term that a document holds have no rows; without
    documents the result is empty. Other columns are ignored.

    Every shard of the index is searched by all queries with bounds of its own; the
    lists of its best are merged up a tree. Query terms are broadcast in blocks of
    at most ``query_bytes`` or one query; each block is one scan of the index.
    """
    spark = df.sparkSession
    with Scratch(spark) as scratch:
        index = lexical_index(df, scratch, id_col, text_col)
        wanted = scratch.stage(_weighted_queries(index, queries, item_col, item_text_col), "queries")
        weight = wanted.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0
        n_blocks = max(1, -(-weight // query_bytes))
        n_shards = index.shards.count()
        block = F.pmod(F.xxhash64("q"), F.lit(n_blocks))
        lists = []
        for i in range(n_blocks):
            terms: dict[int, list] = {}
            items = {}
            for r in wanted.filter(block == i).collect():
                terms.setdefault(r["q"], []).append((bytes(r["word"]), r["w"]))
                items[r["q"]] = r["item_id"]
            held = spark.sparkContext.broadcast((terms, items))
            with single_rows(spark):
                lists.append(scratch.stage(_searched(index, held, wanted, k), "tops"))
        tops = lists[0]
        for more in lists[1:]:
            tops = tops.unionByName(more)
        best = stage(merge_tops(tops, ["q", "item_id"], k, max(1, n_shards)), "best")
    return best.select("item_id", F.posexplode("top").alias("place", "t")).select(
        "item_id", (F.col("place") + 1).alias("rank"), F.col("t.id").alias("doc_id"),
        (-F.col("t.less")).alias("score"),
    )


def _searched(index: Index, held, wanted: DataFrame, k: int) -> DataFrame:
    """``q, item_id, node, top`` of every shard for one block of queries."""
    docs = index.shards.select(F.explode("docs").alias("d")).select("d.doc_id")
    doc_kind, item_kind = id_type(docs, "doc_id").simpleString(), id_type(wanted, "item_id").simpleString()
    item_arrow = arrow_type(wanted, "item_id")

    def run(source):
        terms, items = held.value
        asked = {word for each in terms.values() for word, _ in each}
        for batch in source:
            for i in range(batch.num_rows):
                ids = batch["docs"].slice(i, 1).flatten().field(0)
                rank = np.empty(len(ids), "i8")
                rank[pc.sort_indices(ids, null_placement="at_start").to_numpy()] = np.arange(len(ids))
                row = {c: batch[c][i].as_py() for c in POSTINGS}
                shard = _Shard(row, batch["words"].slice(i, 1).flatten(), asked, rank)
                found = {q: shard.best(each, k) for q, each in terms.items()}
                found = {q: x for q, x in found.items() if len(x[0])}
                if not found:
                    continue
                scores = np.concatenate([s for s, _ in found.values()])
                places = np.concatenate([p for _, p in found.values()])
                ends = np.cumsum([len(s) for s, _ in found.values()])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(found), pa.int64()),
                        pa.array([items[q] for q in found], item_arrow),
                        pa.array([batch["shard"][i].as_py()] * len(found), pa.int64()),
                        top_lists(-scores, ids.take(pa.array(places)), ends),
                    ],
                    names=["q", "item_id", "node", "top"],
                )

    return index.shards.select("shard", "docs", "words", *POSTINGS).mapInArrow(
        run, f"q long, item_id {item_kind}, node long, top array<struct<less: long, id: {doc_kind}>>"
    )
