"""SimHash near-duplicates by bit-sliced comparison."""

from __future__ import annotations

import string
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, require
from .common import join_groups, shuffle_width, stage, thin
from .components import components

BITS = 64
SEED = 42
_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())

#: Rows whose planes are compared at once.
CHUNK = 1 << 16
#: Words of 64 pairs in a block that is abandoned together.
WIDE = 8
#: Bit planes between two looks at which blocks are still alive.
EVERY = 8
#: Larger buckets are searched breadth first.
SMALL = 2048
#: Larger buckets are dealt to several tasks, block against block.
BLOCK = 16_384
#: Links that are held before they are reduced to a spanning forest.
HELD = 1 << 19


def fingerprint(text: str, shingle: int) -> int:
    """Majority of the shingles' XXH64 bits; no word gives zero."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends)])
    return majority(np.frombuffer(hashes, np.uint8).reshape(-1, 8))


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half the big-endian hashes, one row each."""
    total = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        total += np.unpackbits(hashes[start : start + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big")


def fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """The rows with ``fp``, a long with the fingerprint's bits, after their ``text``."""
    names = rows.columns

    def run(source):
        for batch in source:
            found = [fingerprint(t.as_py() or "", shingle) for t in batch["text"]]
            values = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.int64())], names=[*names, "fp"]
            )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("fp", T.LongType())]))


# ---- bit-sliced comparison -----------------------------------------------------


def planes_of(values: np.ndarray) -> np.ndarray:
    """Vertical planes: row b holds bit b of all values, 64 to a word, zero padded."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    pad = -packed.shape[1] % 8
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, pad)))).view("<u8")


def shifted(planes: np.ndarray, by: int, width: int) -> np.ndarray:
    """The first ``width`` words of planes whose place i holds what was at i + by."""
    words, bits = divmod(by, 64)
    planes = planes[:, words : words + width + 1]
    out = np.zeros((len(planes), width), np.uint64)
    n = min(width, planes.shape[1])
    out[:, :n] = planes[:, :n] >> np.uint64(bits)
    if bits and planes.shape[1] > 1:
        n = min(width, planes.shape[1] - 1)
        out[:, :n] |= planes[:, 1 : n + 1] << np.uint64(64 - bits)
    return out


def within(left: np.ndarray, right: np.ndarray, alive: np.ndarray, radius: int) -> np.ndarray:
    """Places (one bit each) where left and right differ in at most ``radius`` bits.

    ``right`` may be one column of all-ones or all-zero words: a single query.
    The differences of 64 pairs are added at once: a carry-save counter per
    place, one word per digit, with an overflow word for counts beyond the
    radius. After every few planes the blocks in which no pair is left are
    dropped from all further work.
    """
    digits = max(1, radius.bit_length())
    width = left.shape[1]
    blocks = -(-width // WIDE)
    pad = blocks * WIDE - width

    def blocked(x):
        return np.pad(x, ((0, 0), (0, pad))).reshape(len(x), blocks, WIDE)

    single = right.shape[1] == 1
    left, live = blocked(left), blocked(alive[None])[0]
    right = right[:, :, None] if single else blocked(right)
    out = np.zeros((blocks, WIDE), np.uint64)
    at = np.flatnonzero(live.any(axis=1))
    live = live[at]
    counters = np.zeros((digits, len(at), WIDE), np.uint64)
    over = ~live
    for start in range(0, BITS, EVERY):
        if not len(at):
            break
        for plane in range(start, start + EVERY):
            carry = left[plane, at] ^ (right[plane] if single else right[plane, at])
            for d in range(digits):
                counters[d], carry = counters[d] ^ carry, counters[d] & carry
            over |= carry
        over |= _above(counters, radius)
        keep = (over != np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)
        if not keep.all():
            at, counters, over = at[keep], counters[:, keep], over[keep]
    out[at] = ~over
    return out.reshape(-1)[:width]


def _above(counters: np.ndarray, radius: int) -> np.ndarray:
    """Places whose counter is larger than ``radius``."""
    above = np.zeros_like(counters[0])
    equal = ~above
    for d in range(len(counters) - 1, -1, -1):
        if radius >> d & 1:
            equal &= counters[d]
        else:
            above |= equal & counters[d]
            equal &= ~counters[d]
    return above


def places(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star per component: each place with its component's smallest place."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def links_in_buckets(values: np.ndarray, sizes: np.ndarray, radius: int):
    """Links within buckets that lie one after another, the largest first.

    Place i is compared with place i + 1, then i + 2 and so on, all places at
    once; only the places whose bucket is that large take part.
    """
    planes, n = planes_of(values), len(values)
    rest = np.concatenate([np.arange(k, 0, -1) for k in sizes])  # places to the bucket's end
    ends = np.cumsum(sizes)
    found, held = [], 0
    for shift in range(1, int(sizes[0])):
        live = int(ends[np.searchsorted(-sizes, -shift, "left") - 1])  # buckets above the shift
        words = -(-live // 64)
        alive = np.zeros(words * 64, np.uint8)
        alive[:live] = rest[:live] > shift
        alive = np.packbits(alive, bitorder="little").view("<u8")
        hit = places(within(planes[:, :words], shifted(planes, shift, words), alive, radius))
        if len(hit):
            found.append((hit, hit + shift))
            held += len(hit)
            if held > HELD:
                found = [forest(*map(np.concatenate, zip(*found)), n)]
                held = len(found[0][0])
    return forest(*map(np.concatenate, zip(*found)), n) if found else None


def links_by_search(values: np.ndarray, radius: int):
    """A spanning set of links of one large bucket.

    Breadth first: a fingerprint is compared once with all that no search has
    reached yet, and links to those it reaches; what two reached ones would add
    is connected already. A dense group ends as soon as none is left to reach.
    """
    index, planes, waiting = np.arange(len(values)), planes_of(values), _ones(len(values))
    left, queue, found = len(values), [], []
    while left:
        if queue:
            one, value = queue.pop()
        else:
            word = np.flatnonzero(waiting)[0]
            low = int(waiting[word])
            at = int(word) * 64 + (low & -low).bit_length() - 1
            one, value = index[at], values[at]
            waiting[word] ^= np.uint64(low & -low)
            left -= 1
        hit = places(within(planes, _query(value), waiting, radius))
        if len(hit):
            np.bitwise_xor.at(waiting, hit // 64, np.uint64(1) << (hit % 64).astype(np.uint64))
            found.append((np.full(len(hit), one), index[hit]))
            queue += zip(index[hit], values[hit])
            left -= len(hit)
        if 4 * left < len(values) and left:
            kept = places(waiting)
            index, values = index[kept], values[kept]
            planes, waiting = planes_of(values), _ones(left)
    return tuple(map(np.concatenate, zip(*found))) if found else None


def _ones(n: int) -> np.ndarray:
    bits = np.zeros(-(-n // 64) * 64, np.uint8)
    bits[:n] = 1
    return np.packbits(bits, bitorder="little").view("<u8").copy()


def _query(value) -> np.ndarray:
    bits = int(value) & (1 << BITS) - 1
    full = 0xFFFFFFFFFFFFFFFF
    return np.array([[full if bits >> k & 1 else 0] for k in range(BITS)], "<u8")


def _bucket_links(source, radius: int):
    """Links of the buckets in a sorted stream of ``bucket, fp`` rows, as batches."""

    def links(sizes, values):
        order = np.argsort(-sizes, kind="stable")
        starts = np.cumsum(sizes) - sizes
        large = order[sizes[order] > SMALL]
        for k in large:
            own = values[starts[k] : starts[k] + sizes[k]]
            if (got := links_by_search(own, radius)) is not None:
                yield own[got[0]], own[got[1]]
        order = order[(sizes[order] <= SMALL) & (sizes[order] > 1)]
        if len(order):
            own = np.concatenate([values[starts[k] : starts[k] + sizes[k]] for k in order])
            if (got := links_in_buckets(own, sizes[order], radius)) is not None:
                yield own[got[0]], own[got[1]]

    def chunk(keys, values, last):
        borders = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if not last:
            if not len(borders):
                return 0, []
            values, borders = values[: borders[-1]], borders[:-1]
        sizes = np.diff(np.r_[0, borders, len(values)])
        return len(values), [
            pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            for a, b in links(sizes, values)
        ]

    keys, values = np.empty((0, 4), np.int64), np.empty(0, np.int64)
    for batch in source:
        own = np.stack([batch[c].to_numpy() for c in ("mask", "key", "i", "j")], axis=1)
        keys, values = np.concatenate([keys, own]), np.concatenate([values, batch["fp"].to_numpy()])
        if len(values) >= CHUNK:
            used, out = chunk(keys, values, False)
            yield from out
            keys, values = keys[used:], values[used:]
    if len(values):
        yield from chunk(keys, values, True)[1]


def band_masks(radius: int, count: int) -> list[int]:
    """Bit masks such that two fingerprints within the radius agree under at least one.

    The bits are cut into ``radius + more`` bands; ``radius`` differences leave
    ``more`` bands untouched, so one mask for each choice of ``more`` bands finds
    every pair. More bands give more masks with longer keys: the fewest are taken
    that leave about 2,000 unrelated fingerprints to a bucket. The links found do
    not depend on that choice.
    """
    if radius >= BITS:
        return [0]
    for more in range(1, BITS - radius + 1):
        bands = radius + more
        cuts = [BITS * k // bands for k in range(bands + 1)]
        if count >> min(cuts[more], 62) <= 2048 or more == 4:
            break
    whole = [sum(1 << b for b in range(x, y)) for x, y in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(whole, more)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` that connect all distinct ``fp`` within the radius.

    A link is a pair within the radius; pairs that the links already connect may
    be left out. Fingerprints meet in buckets of equal bits under a mask. A bucket
    of more than ``BLOCK`` is cut into blocks, and each two blocks meet in a task
    of their own, so no task holds more than two blocks.
    """
    masks = band_masks(radius, fps.count())
    rows = fps.select(
        "fp", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask")
    ).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    hot = (
        rows.groupBy("mask", "key").count().filter(F.col("count") > BLOCK)
        .select("mask", "key", F.ceil(F.col("count") / BLOCK).alias("blocks"))
    )
    rows = rows.join(hot, ["mask", "key"], "left").withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1)))
    )
    others = F.filter(
        F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1),
        lambda x: (x != F.col("own")) | F.col("blocks").isNull(),
    )
    rows = rows.withColumn("other", F.explode(others)).select(
        "mask", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"
    )
    bucket = ["mask", "key", "i", "j"]
    return (
        rows.repartition(shuffle_width(fps.sparkSession), *bucket)
        .sortWithinPartitions(*bucket)
        .mapInArrow(lambda source: _bucket_links(source, radius), "a long, b long")
    )


def classes(docs: DataFrame, radius: int) -> DataFrame:
    """``fp, size, root, component_id`` for each distinct ``fp`` of ``doc_id, fp`` rows, written.

    ``root`` is the class's smallest fingerprint, ``component_id`` its smallest
    ``doc_id``. Equal fingerprints become one before they are compared.
    """
    sizes = docs.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("size"))
    fps = stage(sizes, "fingerprints")
    found = components(near_links(fps, radius)).withColumnRenamed("node", "fp")
    fps = fps.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = fps.groupBy("root").agg(F.min("first").alias("component_id"))
    found = fps.join(least, "root").select("fp", "size", "root", "component_id")
    return stage(found, "classes")


def near_duplicates(
    df: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint, component_id``.

    Words are runs without white space, A-Z in lower case; shingles of ``shingle``
    words count as often as they occur. A shorter text is one shingle. A null,
    empty or blank text has the fingerprint zero, linked like any other. Rows are
    linked when their fingerprints differ in at most ``radius`` bits, and
    ``component_id`` is the smallest identifier that links reach; null identifiers
    are not chosen unless there is no other. Repeated rows share their class. An
    empty table gives an empty result. Other columns are ignored.
    """
    found = fingerprints(thin(df, id_col, text_col), shingle)
    docs = stage(found.select("doc_id", "fp"), "simhash")
    return join_groups(docs, classes(docs, radius), ["fp"], docs.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    df: DataFrame,
    shingle: int = 4,
    radius: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The input rows without those that have an earlier near-duplicate.

    One row of each class stays: the one with the smallest identifier, a null one
    last; of rows that share it, the one with the smallest fingerprint, and of
    equal ones any single one. Decisions are made on a thin table; the rows
    themselves are shuffled once.
    """
    require(df, [id_col, text_col])
    other = [col(c) for c in df.columns if c != text_col]
    rows = df.select(
        F.struct(*other).alias("row"), col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text")
    )
    rows = stage(
        fingerprints(rows, shingle).withColumn("at", F.monotonically_increasing_id()), "simhash"
    )
    slim = rows.select("doc_id", "fp", "at")
    own = join_groups(slim, classes(slim, radius), ["fp"], rows.count())
    own = own.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = own.groupBy("root").agg(F.min(F.struct("fp", "at")).alias("pick")).select("pick.at")
    box = F.col("row")
    return rows.join(kept, "at", "left_semi").select(
        *[F.col("text").alias(c) if c == text_col else box.getField(c).alias(c) for c in df.columns]
    )
