"""Best-fit-decreasing packing of token pieces into sequences of fixed capacity."""

from __future__ import annotations

import os
from array import array
from dataclasses import dataclass, field
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import Memo, arrow_type, batches, byte_letters
from .common import id_type, stage, thin

#: Rows of the plan, or of the starts of its tasks, that are sent to all tasks at once.
SENT_ROWS = 1 << 18
#: Words whose tokens a task remembers, in each of two generations.
WORDS = 450_000
#: How such a vocabulary cuts a word before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words that normalisation only turns to lower case.
PLAIN = r"[!-~\u00c0-\u00ff]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


class WordTokens:
    """Token numbers of texts whose vocabulary drops white space.

    No piece of such a vocabulary reaches over a space or a line break, so the
    text between them is encoded by itself and remembered. Plain words go straight
    to the library's merges, piece by piece; any other goes through all of the
    library, with its normalisation and its special strings.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.merges = self.tokenizer.model.tokenize
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.size = array(self.code).itemsize
        self.letters = dict(enumerate(byte_letters()))
        self.pattern, self.plain = regex.compile(PIECES), regex.compile(PLAIN)
        self.words = Memo(self._word, WORDS)

    def _word(self, word: str) -> bytes:
        if word.isalpha():  # one piece
            if word.isascii() or self.plain.fullmatch(word):
                low = word.lower()
                return self._piece(word) if low == word else self.words[low]
        elif word[-1] in ".,!?;:" and word[:-1].isalpha():
            return self.words[word[:-1]] + self.words[word[-1]]
        if not self.plain.fullmatch(word) or "<|" in word:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return array(self.code, ids).tobytes()
        low = word.lower()
        pieces = self.pattern.findall(low)
        if len(pieces) > 1:
            return b"".join([self.words[p] for p in pieces])
        return self._piece(word) if low == word else self.words[low]

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.merges(piece)]).tobytes()

    def narrow(self, text: str) -> bytes:
        """Little-endian unsigned numbers of ``size`` bytes."""
        return b"".join([self.words[w] for w in text.replace("\n", " ").split(" ") if w])

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit numbers."""
        data = self.narrow(text)
        return data if self.size == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One for all tasks of a worker, so that its memo outlives a task."""
    return WordTokens(path)


def token_pieces(
    df: DataFrame,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """``doc_id, row, piece, start, tokens``: each text's tokens and the end mark, cut.

    Only a document of more than ``capacity`` tokens is cut. ``tokens`` holds
    little-endian unsigned 32-bit numbers. ``row`` tells repeated rows apart.
    """
    found = _narrow_pieces(df, capacity, end_id, id_col, text_col, path)
    names = ["doc_id", "row", "piece", "start", "tokens"]

    def widen(source):
        for batch in source:
            tokens = pa.array([_wide(t.as_py(), n.as_py()) for t, n in zip(batch["tokens"], batch["length"])], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names[:-1]], tokens], names=names)

    kind = id_type(found, "doc_id").simpleString()
    return found.mapInArrow(widen, f"doc_id {kind}, row long, piece int, start long, tokens binary")


def _wide(data: bytes, length: int) -> bytes:
    """``length`` numbers of 16 or 32 bits as 32-bit ones."""
    return data if len(data) == 4 * length else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def _narrow_pieces(
    df: DataFrame, capacity: int, end_id: int, id_col: str, text_col: str, path: str | None
) -> DataFrame:
    """The pieces with ``length``, ``task`` and ``seq``, the place among those of its length in its task.

    Numbers have 16 bits if the vocabulary and the end mark allow it.
    """
    path = path or default_path()

    def run(source):
        words = word_tokens(path)
        size = words.size if end_id < 1 << 16 else 4
        encode = words.narrow if size == words.size else words.encode
        end, step = end_id.to_bytes(size, "little"), size * capacity
        met: dict[int, int] = {}

        def pieces(batch):
            for i, row, text in zip(batch["doc_id"], batch["row"], batch["text"]):
                data = encode(text.as_py()) + end
                doc, row = i.as_py(), row.as_py()
                for at in range(0, len(data), step):
                    own = data[at : at + step]
                    n = len(own) // size
                    seq = met.get(n, 0)
                    met[n] = seq + 1
                    yield doc, row, at // step, at // size, n, row >> 33, seq, own

        for batch in source:
            yield from batches(pieces(batch), schema, lambda row: len(row[-1]))

    rows = thin(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    schema = pa.schema(
        [("doc_id", arrow_type(rows)), ("row", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
         ("length", pa.int64()), ("task", pa.int64()), ("seq", pa.int64()), ("tokens", pa.binary())]
    )
    kind = id_type(rows, "doc_id").simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, row long, piece int, start long, length long, task long, seq long, tokens binary",
    )


class CapacityTree:
    """Segment tree over remaining capacities; a node counts the ranges of open bins below."""

    def __init__(self, capacity: int):
        self.base = 1
        while self.base <= capacity:
            self.base *= 2
        self.count = [0] * (2 * self.base)

    def add(self, remaining: int, change: int) -> None:
        node = self.base + remaining
        while node:
            self.count[node] += change
            node //= 2

    def tightest(self, least: int) -> int | None:
        """Smallest capacity of at least ``least`` that an open bin has."""
        node = self.base + least
        if self.count[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.base:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.base
            node //= 2
        return None


@dataclass
class Plan:
    """Rows say: pieces ``rank .. rank + count - 1`` of a length go to the sequences
    from ``first`` on, one each, at ``offset``."""

    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0

    def put(self, length, rank, first, offset):
        self.length.append(length)
        self.rank.append(rank)
        self.first.append(first)
        self.offset.append(offset)


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """The packing that best fit gives when all pieces come in order of falling length.

    Pieces of one length are alike, and so are bins filled alike, so a run of
    bins is one range of numbers with one remaining capacity. Each step finds the
    tightest capacity in the tree and fills as many bins of a range as the pieces
    of this length reach. The work and the plan depend on the capacity and the
    pattern of lengths, not on the number of documents: each length splits at most
    one range and opens at most two, so there are at most ``3 * capacity`` ranges
    and ``3 * capacity ** 2`` steps.
    """
    tree = CapacityTree(capacity)
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    plan = Plan()

    def open_range(remaining, first, count):
        if count:
            ranges[remaining].append((first, count))
            tree.add(remaining, 1)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, each = capacity, capacity // length
                first, bins = plan.sequences, -(-left // each)
                plan.sequences += bins
            else:
                first, bins = ranges[remaining].pop()
                tree.add(remaining, -1)
                each = remaining // length
            full = min(bins, left // each)
            if full:
                for k in range(each):
                    plan.put(length, rank, first, capacity - remaining + k * length)
                    rank += full
                open_range(remaining - each * length, first, full)
                left -= each * full
            used = full
            if left and full < bins:  # fewer than one bin takes
                for k in range(left):
                    plan.put(length, rank, first + full, capacity - remaining + k * length)
                    rank += 1
                open_range(remaining - left * length, first + full, 1)
                left, used = 0, full + 1
            open_range(remaining, first + used, bins - used)
    return plan


def pack(
    df: DataFrame,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, tokens, sequence_id, offset, ids_crc32``.

    ``tokens`` holds the piece's numbers as ``token_pieces`` gives them; those of
    one ``sequence_id`` in the order of ``offset`` are a packed sequence.
    ``ids_crc32`` is their checksum. A null or empty text is one piece with only the end mark. Repeated rows are
    packed each. An empty table gives an empty result. Other columns are ignored.

    The texts are read and encoded once, into a written table. Best fit
    needs only the number of pieces of each length, at most ``capacity`` numbers.
    Its plan is sent to the tasks, which look up each piece by its rank among those of its
    length: the number of its task's pieces before it, and of those of all tasks before.
    So no token is shuffled while there are at most ``SENT_ROWS`` pairs of a task and a
    length; beyond that these are joined by both. A plan of more rows than that is sent in bands of
    lengths, one scan of the pieces each.
    """
    spark = df.sparkSession
    pieces = stage(_narrow_pieces(df, capacity, end_id, id_col, text_col, path), "pieces")
    counted = pieces.groupBy("length", "task").count()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        counted.select("length", "task", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")),
        "starts",
    )
    counts = {r["length"]: r["n"] for r in starts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    starts = starts.drop("count")
    if starts.count() <= SENT_ROWS:
        starts = F.broadcast(starts)
    ranked = pieces.join(starts, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "tokens", (F.col("before") + F.col("seq")).alias("rank")
    )
    return placed(ranked, best_fit_decreasing(counts, capacity), spark)


def _bands(lengths: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Ranges of sorted lengths with at most ``limit`` rows each, or a single length."""
    own, starts = np.unique(lengths, return_index=True)
    bands, first, begin = [], None, 0
    for length, start, end in zip(own, starts, [*starts[1:], len(lengths)]):
        if first is None or end - begin > limit:
            first, begin = int(length), start
            bands.append([first, first])
        bands[-1][1] = int(length)
    return [tuple(b) for b in bands] or [(0, 0)]


def placed(ranked: DataFrame, plan: Plan, spark, limit: int | None = None) -> DataFrame:
    """``ranked`` with ``sequence_id``, ``offset`` and the tokens' checksum in place of ``rank``."""
    order = np.lexsort((plan.rank, plan.length))
    rows = [np.array(x, "i8")[order] for x in (plan.length, plan.rank, plan.first, plan.offset)]
    found = None
    for low, high in _bands(rows[0], limit or SENT_ROWS):
        inside = (rows[0] >= low) & (rows[0] <= high)
        shared = spark.sparkContext.broadcast([x[inside] for x in rows])
        part = _placed(ranked.filter(F.col("length").between(low, high)), shared)
        found = part if found is None else found.unionByName(part)
    return found


def _placed(ranked: DataFrame, shared) -> DataFrame:
    names = [c for c in ranked.columns if c not in ("rank", "tokens")]

    def run(source):
        lengths, ranks, firsts, offsets = shared.value
        starts = np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1]]) if len(lengths) else []
        span = {int(lengths[s]): (s, e) for s, e in zip(starts, [*starts[1:], len(lengths)])}
        for batch in source:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = np.empty(len(length), "i8")
            for one in np.unique(length):
                here = length == one
                s, e = span[int(one)]
                row[here] = s + np.searchsorted(ranks[s:e], rank[here], "right") - 1
            tokens = [_wide(t.as_py(), n) for t, n in zip(batch["tokens"], length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in names],
                    pa.array(tokens, pa.binary()),
                    pa.array(firsts[row] + rank - ranks[row], pa.int64()),
                    pa.array(offsets[row], pa.int64()),
                    pa.array([crc32(t) for t in tokens], pa.int64()),
                ],
                names=[*names, "tokens", "sequence_id", "offset", "ids_crc32"],
            )

    kinds = dict(ranked.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names)
    return ranked.mapInArrow(run, f"{schema}, tokens binary, sequence_id long, offset long, ids_crc32 long")
