"""Sparse document-term matrices, in shards of compressed rows."""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Scratch, shuffle_width

#: Non-zero cells after which a shard ends.
SHARD_CELLS = 1 << 22

Words = Callable[[bytes], list[bytes]]
#: A name, an Arrow type and a function of the text's bytes.
Fact = tuple[str, pa.DataType, Callable[[bytes], object]]


def packed(numbers) -> bytes:
    """Non-negative numbers in the narrowest of 1, 2, 4 or 8 bytes, whose width comes first."""
    numbers = np.asarray(numbers)
    most = int(numbers.max()) if numbers.size else 0
    size = next(s for s in (1, 2, 4, 8) if most < 1 << 8 * s)
    return bytes([size]) + numbers.astype(f"<u{size}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("i8")


class _Rows:
    """Rows of a shard so far; words are numbered as they come."""

    def __init__(self):
        self.ids, self.counts, self.ends = array("I"), array("I"), array("q")
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__

    def add(self, words: list[bytes]) -> None:
        found = Counter(words)
        self.ids.extend(map(self.words.__getitem__, found))
        self.counts.extend(found.values())
        self.ends.append(len(self.ids))


def term_shards(
    df: DataFrame, words: Words, facts: Sequence[Fact] = (), cells: int = SHARD_CELLS
) -> DataFrame:
    """``shard, docs, ends, ids, counts, words, holders`` for blocks of the rows of ``df``.

    ``df`` has ``text`` and columns to keep. ``docs`` lists the kept columns and
    the facts of each row; row i has the cells up to ``ends[i]``, with a word's number in
    ``ids`` and its occurrences in ``counts`` (``unpacked`` reads them). Numbers are
    places in ``words``, the shard's own; ``holders`` counts the rows with each word.
    A shard holds ``cells`` cells and what its last row has beyond.
    """
    keep = [f for f in df.schema.fields if f.name != "text"]

    def run(source):
        rows, held, extra = _Rows(), [], [[] for _ in facts]

        def shard():
            docs = [pa.concat_arrays([b[f.name] for b in held]) for f in keep]
            docs += [pa.array(x, kind) for x, (_, kind, _) in zip(extra, facts)]
            docs = pa.StructArray.from_arrays(docs, fields=list(fields))
            holders = np.bincount(np.asarray(rows.ids, "i8"), minlength=len(rows.words))
            row = [
                held[0]["shard"].slice(0, 1),
                pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                *[pa.array([packed(x)], pa.binary()) for x in (rows.ends, rows.ids, rows.counts)],
                pa.array([list(rows.words)], pa.list_(pa.binary())),
                pa.array([holders], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(
                row, names=["shard", "docs", "ends", "ids", "counts", "words", "holders"]
            )

        for batch in source:
            start, slim = 0, batch.select(["shard", *[f.name for f in keep]])
            for i, text in enumerate(batch["text"]):
                data = text.as_py()
                rows.add(words(data))
                for (_, _, of), values in zip(facts, extra):
                    values.append(of(data))
                if len(rows.ids) >= cells:
                    held.append(slim.slice(start, i + 1 - start))
                    yield shard()
                    rows, held, extra, start = _Rows(), [], [[] for _ in facts], i + 1
            if start < batch.num_rows:
                held.append(slim.slice(start))
        if held:
            yield shard()

    fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in keep]
    fields += [pa.field(name, kind) for name, kind, _ in facts]
    sql = {pa.bool_(): "boolean", pa.binary(): "binary", pa.int64(): "long"}
    docs = [f"`{f.name}`: {f.dataType.simpleString()}" for f in keep]
    docs += [f"`{name}`: {sql[kind]}" for name, kind, _ in facts]
    return df.select(
        F.monotonically_increasing_id().alias("shard"),
        F.col("text").cast("binary").alias("text"),
        *[F.col(f.name) for f in keep],
    ).mapInArrow(
        run,
        f"shard long, docs array<struct<{', '.join(docs)}>>, ends binary, ids binary, counts binary, "
        "words array<binary>, holders array<long>",
    )


def numbered_words(shards: DataFrame, scratch: Scratch) -> DataFrame:
    """``part, shard, places, numbers, first, words``: the dictionary, written.

    A word belongs to one part, by a hash. Each part meets the words of all shards,
    block by block, and numbers them as they come: the words at ``places`` of the
    shard have these ``numbers``; ``words`` are those not met before, numbered from
    ``first``. A block of words is one row, so nothing is shuffled word by word.
    """
    parts = 2 * shuffle_width(shards.sparkSession)

    def blocks(source):
        for batch in source:
            for shard, words in zip(batch["shard"], batch["words"]):
                words = words.values
                part = np.fromiter(map(crc32, words.to_pylist()), "i8", len(words)) % parts
                order = np.argsort(part, kind="stable")
                own, starts = np.unique(part[order], return_index=True)
                ends = np.r_[starts, len(order)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, pa.int64()),
                        pa.array([shard.as_py()] * len(own), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(order))),
                        pa.array([packed(order[a:b]) for a, b in zip(ends, ends[1:])], pa.binary()),
                    ],
                    names=["part", "shard", "words", "places"],
                )

    def number(source):
        known: dict[int, dict[bytes, int]] = {}
        for batch in source:
            numbers, firsts, fresh = [], [], []
            for part, words in zip(batch["part"].to_pylist(), batch["words"]):
                if part not in known:
                    known[part] = defaultdict()
                    known[part].default_factory = known[part].__len__
                held = known[part]
                firsts.append(len(held))
                words = words.as_py()
                found = [held[w] for w in words]
                numbers.append(packed(found))
                fresh.append([w for w, n in zip(words, found) if n >= firsts[-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    batch["part"], batch["shard"], batch["places"], pa.array(numbers, pa.binary()),
                    pa.array(firsts, pa.int64()), pa.array(fresh, pa.list_(pa.binary())),
                ],
                names=["part", "shard", "places", "numbers", "first", "words"],
            )

    own = shards.select("shard", "words").mapInArrow(
        blocks, "part long, shard long, words array<binary>, places binary"
    )
    return scratch.stage(
        own.repartition(parts, "part").mapInArrow(
            number, "part long, shard long, places binary, numbers binary, first long, words array<binary>"
        ),
        "dictionary",
    )


def _with_starts(numbered: DataFrame) -> DataFrame:
    """``numbered`` and the first number of each part, so that the whole has no gap."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy("part").agg(F.sum(F.size("words")).alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return numbered.join(F.broadcast(starts), "part")  # as many rows as parts


def dictionary(numbered: DataFrame) -> DataFrame:
    """``term_id, word`` of all shards, numbered 0, 1, 2, ... without a gap."""
    words = _with_starts(numbered).select("start", "first", F.posexplode("words").alias("place", "word"))
    return words.select((F.col("start") + F.col("first") + F.col("place")).alias("term_id"), "word")


def global_shards(shards: DataFrame, numbered: DataFrame) -> DataFrame:
    """``shard, docs, ends, ids, counts`` with the numbers of the dictionary."""
    names = ["shard", "docs", "ends", "ids", "counts"]
    numbers = _with_starts(numbered).select("shard", "places", "numbers", "start")
    numbers = numbers.toDF(*numbers.columns)  # names of its own beside those of the cells

    def renumber(left: pa.Table, right: pa.Table) -> pa.Table:
        own = [
            (unpacked(p.as_py()), unpacked(n.as_py()) + start.as_py())
            for p, n, start in zip(right["places"], right["numbers"], right["start"])
        ]
        term = np.empty(sum(len(p) for p, _ in own), "i8")
        for places, found in own:
            term[places] = found
        ids = pa.array([packed(term[unpacked(x.as_py())]) for x in left["ids"]], pa.binary())
        return pa.Table.from_arrays([left[c] if c != "ids" else ids for c in names], names=names)

    cells = shards.select(*names)
    return cells.groupBy("shard").cogroup(numbers.groupBy("shard")).applyInArrow(renumber, cells.schema)


def row_sums(shards: DataFrame) -> DataFrame:
    """One row per document: the columns of ``docs``, its sum of cells ``n_words`` and their number ``n_distinct``."""
    docs = shards.schema["docs"].dataType.elementType

    def run(source):
        for batch in source:
            for i in range(batch.num_rows):
                rows = batch["docs"].slice(i, 1).flatten()
                ends = unpacked(batch["ends"][i].as_py())
                sums = np.r_[0, np.cumsum(unpacked(batch["counts"][i].as_py()))]
                starts = np.r_[0, ends[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [*rows.flatten(), pa.array(sums[ends] - sums[starts]), pa.array(ends - starts)],
                    names=[*docs.names, "n_words", "n_distinct"],
                )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.fields)
    return shards.mapInArrow(run, f"{kept}, n_words long, n_distinct long")
