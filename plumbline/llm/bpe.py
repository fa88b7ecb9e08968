"""Byte-level BPE as a streaming transducer, and the decoder as a state machine."""

from __future__ import annotations

import codecs
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col, require
from .common import id_type, thin

#: How the byte-level vocabulary's text is cut before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters, digits, the rest and white space: runs that one piece may go on with.
RUNS = tuple(regex.compile(p) for p in (r"\p{L}*", r"\p{N}*", r"[^\s\p{L}\p{N}]*", r"\s*"))
#: Characters held at once; longer texts pass through in blocks.
BLOCK = 1 << 15
#: Entries that a memo keeps before it starts anew.
MEMO = 150_000
#: A pair of tokens, or a rank and the token it makes, are one number.
BITS, LOW = 20, (1 << 20) - 1
NEVER = 1 << 62
#: Pieces above this many bytes are merged with a heap, window by window.
SHORT = 48


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = dict.fromkeys(plain)
    extra = iter(range(256, 512))
    return [chr(b if b in letters else next(extra)) for b in range(256)]


class Memo(dict):
    """A function's results by argument, in two generations of bounded size.

    Once the young one is full it replaces the old one; what is asked for again
    comes back from there.
    """

    def __init__(self, function, limit: int = MEMO):
        super().__init__()
        self.function, self.limit, self.old = function, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
            if len(key) > 4 * SHORT:
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Merges:
    """Merge rules of a tokenizer file whose letters stand for bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.vocab = vocab = spec["model"]["vocab"]
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.byte_ids = [vocab[c] for c in self.letters]
        self.joined = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.joined.setdefault(vocab[a] << BITS | vocab[b], rank << BITS | vocab[a + b])

    def merge_ids(self, ids: list[int]) -> list[int]:
        """Tokens that the rules make of a piece's tokens: the lowest rule first, from the left."""
        if len(ids) > SHORT:
            return self._merge_long(ids)
        made_by = self.joined.get
        offers = [made_by(a << BITS | b, NEVER) for a, b in zip(ids, ids[1:])]
        while offers:
            best = min(offers)
            if best == NEVER:
                break
            i = offers.index(best)
            ids[i] = new = best & LOW
            del ids[i + 1], offers[i]
            if i < len(offers):
                offers[i] = made_by(new << BITS | ids[i + 1], NEVER)
            if i:
                offers[i - 1] = made_by(ids[i - 1] << BITS | new, NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        joined, n = self.joined, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i):
            j = after[i]
            if j < n and (found := joined.get(ids[i] << BITS | ids[j])):
                heapq.heappush(heap, (found >> BITS, i, ids[i], ids[j], found & LOW))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [t for t in ids if t >= 0]


class ByteBpe(Merges):
    """A byte-level vocabulary: any text is a sequence of its tokens."""

    def __init__(self, path: str):
        super().__init__(path)
        byte_of = {c: b for b, c in enumerate(self.letters)}
        size = max([*self.vocab.values(), *self.special.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in self.vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.special_pattern = regex.compile(
            "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or r"(?!)"
        )
        self.special_hold = max(map(len, self.special), default=1) - 1
        self.lookahead = self.sufficient_lookahead()

    def merge(self, data: bytes) -> list[int]:
        """Tokens of one piece."""
        return self.merge_ids([self.byte_ids[b] for b in data])

    def sufficient_lookahead(self) -> int:
        """Bytes after which no continuation of the text changes a token.

        Compare the merging of one text with two continuations. The tokens that
        both share end at some border; it moves left only when a rule joins the
        last shared token ``u`` with what begins at the border, and then by
        ``u``. What begins at the border has the token of the move before (or
        its ``u``) at its left edge, and rules apply in rank order. So the moves
        form a chain of rules of rising rank in which each right part has the
        previous left part on its left edge; the longest chain in bytes bounds
        how far the border can move, and one more token covers the border itself.
        """
        rules = [(pair >> BITS, pair & LOW, made & LOW) for pair, made in
                 sorted(self.joined.items(), key=lambda x: x[1])]
        parts = {new: a for a, _, new in rules}
        reach = [0] * len(self.token_bytes)  # longest chain whose last left part is this token
        longest = 0
        for a, b, _ in rules:
            best, edge = 0, b
            while True:
                best = max(best, reach[edge])
                if edge not in parts:
                    break
                edge = parts[edge]
            best += len(self.token_bytes[a])
            reach[a] = max(reach[a], best)
            longest = max(longest, best)
        return longest + max(map(len, self.token_bytes))


@lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


class PieceStream:
    """Merges one piece that arrives in parts and gives tokens out once they are stable."""

    def __init__(self, bpe: ByteBpe):
        self.bpe, self.pending = bpe, b""

    def feed(self, data: bytes) -> list[int]:
        out = []
        step = 4 * self.bpe.lookahead
        for start in range(0, len(data), step):
            self.pending += data[start : start + step]
            if len(self.pending) < 2 * self.bpe.lookahead:
                continue
            stable, used = len(self.pending) - self.bpe.lookahead, 0
            for token in self.bpe.merge(self.pending):
                end = used + len(self.bpe.token_bytes[token])
                if end > stable:
                    break
                out.append(token)
                used = end
            self.pending = self.pending[used:]
        return out

    def finish(self) -> list[int]:
        rest, self.pending = self.bpe.merge(self.pending), b""
        return rest


class Encoder:
    """Text in parts to token numbers, with a buffer of fixed size.

    A block is cut at a single space between two words, where pieces always
    part; its words are looked up in a bounded memo. Where a block has no such
    space the pieces are followed one by one, and a piece longer than the block
    goes through ``PieceStream``. Special strings are found before all else.
    """

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        self.pattern = regex.compile(PIECES)
        self.odd_space = regex.compile(r"[^\S \n]|\s\s")
        self.cut = regex.compile(r"(?r)(?<=\S) (?=\S)")
        self.piece = Memo(lambda p: array("I", bpe.merge(p.encode())).tobytes(), 20_000)
        self.first = Memo(self._packed)
        self.later = Memo(lambda w: self._packed(w if w[:1] == "\n" else " " + w))

    def _packed(self, text: str) -> bytes:
        pieces = self.pattern.findall(text)
        if len(pieces) < 2:
            return array("I", self.bpe.merge(text.encode())).tobytes()
        return b"".join(
            [self.later[p[1:]] if p[0] == " " and not p[1:2].isspace() and p[1:] else self.piece[p] for p in pieces]
        )

    def _block(self, text: str) -> bytes:
        """A text whose ends are borders of pieces, without special strings."""
        if self.odd_space.search(text):
            return self._packed(text)
        words = text.replace("\n", " \n").split(" ")
        return self.first[words[0]] + b"".join([self.later[w] for w in words[1:]])

    def encode(self, parts: Iterable[str]) -> Iterator[np.ndarray]:
        """Token numbers of the joined parts, as arrays."""
        special, hold = self.bpe.special_pattern, self.bpe.special_hold
        text, run = "", _PieceRun(self)
        for part in parts:
            for start in range(0, len(part), BLOCK):
                text += part[start : start + BLOCK]
                done = 0
                for found in special.finditer(text):
                    yield from run.feed(text[done : found.start()])
                    yield from run.finish()
                    yield np.array([self.bpe.special[found[0]]], "<u4")
                    done = found.end()
                safe = max(done, len(text) - hold)
                yield from run.feed(text[done:safe])
                text = text[safe:]
        yield from run.feed(text)
        yield from run.finish()


class _PieceRun:
    """The text between two special strings."""

    def __init__(self, encoder: Encoder):
        self.encoder, self.text = encoder, ""
        self.open, self.kind = None, None

    def feed(self, text: str) -> Iterator[np.ndarray]:
        self.text += text
        if len(self.text) < BLOCK:
            return
        if self.open is None and (found := self.encoder.cut.search(self.text)):
            yield self._array(self.encoder._block(self.text[: found.start()]))
            self.text = self.text[found.start() :]
            return
        yield np.array(self._pieces(False), "<u4")

    def finish(self) -> Iterator[np.ndarray]:
        if self.open is not None:
            ids = self._pieces(True)
            yield np.array(ids, "<u4")
        if self.text:
            yield self._array(self.encoder._block(self.text))
        self.text = ""

    @staticmethod
    def _array(data: bytes) -> np.ndarray:
        return np.frombuffer(data, "<u4")

    def _pieces(self, last: bool) -> list[int]:
        """Pieces that can no longer change; the last four characters wait."""
        out = []
        text, encoder = self.text, self.encoder
        safe = len(text) if last else len(text) - 4
        at = 0
        if self.open is not None:
            end = RUNS[self.kind].match(text).end()
            if end >= safe and not last:
                out += self.open.feed(text[:safe].encode())
                self.text = text[safe:]
                return out
            if self.kind == 3 and end < len(text):
                end -= 1  # the last white space belongs to what follows
            out += self.open.feed(text[:end].encode()) + self.open.finish()
            self.open, at = None, end
        if not last:
            for found in encoder.pattern.finditer(text, at):
                if found.end() > safe:
                    break
                out += np.frombuffer(encoder.piece[found[0]], "<u4").tolist()
                at = found.end()
            if len(text) - at >= BLOCK // 2:  # one piece fills the buffer
                probe = text[at + 1] if text[at] == " " and not text[at + 1].isspace() else text[at]
                self.kind = next(k for k, r in enumerate(RUNS) if r.match(probe).end())
                self.open = PieceStream(encoder.bpe)
                out += self.open.feed(text[at:safe].encode())
                at = safe
        self.text = text[at:]
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One for all tasks of a worker, so that its memos outlive a task."""
    return Encoder(load(path))


class Decoder:
    """Token numbers in parts to text; bytes of an unfinished character wait."""

    def __init__(self, bpe: ByteBpe):
        self.token = bpe.token_bytes.__getitem__
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.state.decode(b"".join(map(self.token, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Bytes of a result batch that a Python task gathers before it passes them on.
BATCH_BYTES = 8 << 20


def batches(rows: Iterator[tuple], schema: pa.Schema, weigh) -> Iterator[pa.RecordBatch]:
    """Rows gathered to batches of about ``BATCH_BYTES``."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += weigh(row) + 64
        if weight >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
            )
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
        )


def encode_documents(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """``doc_id, token_ids``: one row per input row, null text as empty (no tokens).

    Ids equal those of the vocabulary's own library without added tokens; the
    text of a special token counts as that token. Repeated rows stay, an empty
    table gives an empty result, other columns are ignored. ``path`` names a
    byte-level tokenizer file that every executor has.
    """
    path = path or default_path()

    def run(source):
        encoder = encoder_of(path)
        for batch in source:
            rows = (
                (i.as_py(), np.concatenate([np.empty(0, "<u4"), *encoder.encode([t.as_py()])]).astype("i4"))
                for i, t in zip(batch["doc_id"], batch["text"])
            )
            yield from batches(rows, schema, lambda row: row[1].nbytes)

    rows = thin(df, id_col, text_col)
    schema = pa.schema([("doc_id", arrow_type(rows)), ("token_ids", pa.list_(pa.int32()))])
    return rows.mapInArrow(run, f"doc_id {id_type(rows, 'doc_id').simpleString()}, token_ids array<int>")


def decode_documents(
    df: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids", path: str | None = None
) -> DataFrame:
    """``doc_id, token_ids, text``: the token numbers and their text.

    Null counts as no tokens. Bytes that are no UTF-8 become replacement
    characters, as in the vocabulary's own library.
    """
    path = path or default_path()
    require(df, [id_col, ids_col])

    def run(source):
        bpe = load(path)
        for batch in source:
            starts = batch["token_ids"].offsets.to_numpy()
            flat = batch["token_ids"].values.to_numpy()
            texts = []
            for a, b in zip(starts, starts[1:]):
                decoder = Decoder(bpe)
                parts = [decoder.feed(flat[k : min(k + BLOCK, b)].tolist()) for k in range(a, b, BLOCK)]
                texts.append("".join(parts) + decoder.finish())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["token_ids"], pa.array(texts, pa.string())],
                names=["doc_id", "token_ids", "text"],
            )

    none = F.expr("array()").cast("array<int>")
    rows = df.select(
        col(id_col).alias("doc_id"),
        F.coalesce(col(ids_col).cast("array<int>"), none).alias("token_ids"),
    )
    kind = id_type(rows, "doc_id").simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, token_ids array<int>, text string")


def arrow_type(df: DataFrame, name: str = "doc_id") -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)
