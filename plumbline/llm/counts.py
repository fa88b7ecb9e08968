"""Token counts of every prefix by dynamic programming over last tokens."""

from __future__ import annotations

from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bpe import BLOCK, PIECES, ByteBpe, Memo, arrow_type, batches, default_path, load
from .common import id_type, thin

#: Pieces that a shorter cut parts in two.
CONTRACTIONS = ("'re", "'ve", "'ll")
#: Words whose counts are remembered, in each of two generations.
WORDS = 500_000
#: Pairs of tokens whose compatibility is remembered.
PAIRS = 400_000


class PrefixCounter:
    """Exact number of tokens of every prefix of a text.

    Within a piece the last token of a prefix is the one vocabulary entry that
    ends there and may follow the last token of the prefix before it, where ``b``
    may follow ``a`` if the merges turn their joined bytes into just ``a, b``.
    So the count at an end is one more than the count at that token's start.
    Pieces add up; where cutting the text changes how it falls into pieces
    (``'re`` cut to ``'r``, a run of white space cut at its end) the count is
    that of the text as cut.
    """

    def __init__(self, bpe: ByteBpe):
        self.bpe = bpe
        self.pattern = regex.compile(PIECES)
        self.odd_space = regex.compile(r"[^\S \n]|\s\s")
        self.gap = regex.compile(r"\s\s+(?=\S)")
        self.cut = regex.compile(r"(?r)(?<=\S) (?=\S)")
        self.ends = ahocorasick.Automaton()
        for i, t in enumerate(bpe.token_bytes):
            if t and i not in bpe.special.values() and bpe.merge(t) == [i]:
                self.ends.add_word(t.decode("latin-1"), (len(t), i))
        self.ends.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.first = Memo(self._entry)
        self.later = Memo(lambda w: self._entry(w if w[:1] == "\n" else " " + w), WORDS)
        self.piece = Memo(self._one, 20_000)

    def _follows(self, a: int, b: int) -> bool:
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        tokens = self.bpe.token_bytes
        fits = self.pairs[a << 20 | b] = self.bpe.merge(tokens[a] + tokens[b]) == [a, b]
        return fits

    def piece_counts(self, data: bytes) -> list[int]:
        """Counts after each byte of one piece.

        The automaton names the tokens that end at each byte, the longest first.
        """
        counts, last, known, solved = [0], [-1], self.pairs.get, 0
        for at, (length, token) in self.ends.iter(data.decode("latin-1")):
            if at < solved:
                continue
            start = at + 1 - length
            if start:
                before = last[start]
                fits = known(before << 20 | token)
                if fits is None:
                    fits = self._follows(before, token)
                if not fits:
                    continue
            counts.append(counts[start] + 1)
            last.append(token)
            solved = at + 1
        return counts[1:]

    def _entry(self, text: str) -> bytes:
        """Counts after each character of a text that may fall into several pieces."""
        pieces = self.pattern.findall(text)
        if len(pieces) < 2:
            return self._one(text) if text else b""
        out, before = [], 0
        for piece in pieces:
            spaced = piece[0] == " " and not piece[1:2].isspace() and len(piece) > 1
            own = self.later[piece[1:]] if spaced else self.piece[piece]
            own = np.frombuffer(own, "<i4") + before
            out.append(own)
            before = own[-1]
        return np.concatenate(out).astype("<i4").tobytes()

    def _one(self, piece: str) -> bytes:
        data = piece.encode()
        own = self.piece_counts(data)
        if len(data) > len(piece):
            at, ends = 0, []
            for c in piece:
                at += len(c.encode())
                ends.append(own[at - 1])
            own = ends
        if piece in CONTRACTIONS:  # a shorter cut is an apostrophe and a letter
            own[1] = sum(self.piece_counts(p.encode())[-1] for p in piece[:2])
        return array("i", own).tobytes()

    def _block(self, text: str) -> np.ndarray:
        """Counts after each character; the ends of the text are borders of pieces."""
        if self.odd_space.search(text):
            out, before = np.empty(len(text), "<i4"), 0
            for found in self.pattern.finditer(text):
                own = np.frombuffer(self.piece[found[0]], "<i4")
                out[found.start() : found.end()] = own + before
                before += own[-1]
            for found in self.gap.finditer(text):
                start = found.start()
                base = out[start - 1] if start else 0
                out[found.end() - 1] = base + np.frombuffer(self.piece[found[0]], "<i4")[-1]
            return out
        words = text.replace("\n", " \n").split(" ")
        tables = [self.first[words[0]], *[self.later[w] for w in words[1:]]]
        lengths = np.fromiter(map(len, tables), np.int64, len(tables)) >> 2
        joined = np.frombuffer(b"".join(tables), "<i4")
        ends = np.cumsum(lengths)
        totals = np.where(lengths, joined[ends - 1], 0)
        return joined + np.repeat((np.cumsum(totals) - totals).astype("<i4"), lengths)

    def _segment(self, text: str) -> np.ndarray:
        """Counts after each character of a text without special strings."""
        parts, before, at = [np.empty(0, "<i4")], 0, 0
        while at < len(text):
            upto = len(text)
            if upto - at > BLOCK and (found := self.cut.search(text, at + 1, at + BLOCK)):
                upto = found.start()
            own = self._block(text[at:upto])
            parts.append(own + before)
            before, at = before + int(own[-1]), upto
        return np.concatenate(parts)

    def counts(self, text: str) -> np.ndarray:
        """Token count of ``text[:k]`` for every k from 0 to the length."""
        out, before, at = [np.zeros(1, "<i4")], 0, 0
        for found in self.bpe.special_pattern.finditer(text):
            ahead = text[at : found.start()]
            own = self._segment(ahead)
            out.append(own + before)
            # cut within the special string, its letters are ordinary text
            border = self.cut.search(ahead)
            border = border.start() if border else 0
            base = before + (int(own[border - 1]) if border else 0)
            partly = self._block(ahead[border:] + found[0][:-1])
            out.append(partly[len(ahead) - border :] + base)
            before += (int(own[-1]) if ahead else 0) + 1
            out.append(np.array([before], "<i4"))
            at = found.end()
        out.append(self._segment(text[at:]) + before)
        return np.concatenate(out)


@lru_cache(maxsize=1)
def prefix_counter(path: str) -> PrefixCounter:
    """One for all tasks of a worker, so that its memos outlive a task."""
    return PrefixCounter(load(path))


def fitting_prefix(counts: np.ndarray, limit: int) -> int:
    """Characters of the longest prefix with at most ``limit`` tokens."""
    return int(np.flatnonzero(counts <= limit)[-1])


def prefix_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """``doc_id, counts``: the token count of every prefix, from none to all characters.

    A null or empty text gives ``[0]``. Repeated rows stay, an empty table gives
    an empty result, other columns are ignored.
    """
    path = path or default_path()

    def run(source):
        counter = prefix_counter(path)
        for batch in source:
            rows = ((i.as_py(), counter.counts(t.as_py())) for i, t in zip(batch["doc_id"], batch["text"]))
            yield from batches(rows, schema, lambda row: row[1].nbytes)

    rows = thin(df, id_col, text_col)
    schema = pa.schema([("doc_id", arrow_type(rows)), ("counts", pa.list_(pa.int32()))])
    return rows.mapInArrow(run, f"doc_id {id_type(rows, 'doc_id').simpleString()}, counts array<int>")


def token_budget(
    df: DataFrame,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fitting_chars`` from the prefix counts.

    ``fitting_chars`` is the length of the longest prefix of at most ``limit``
    tokens, found in the stored counts without encoding anything again. The
    counts of a text stay inside its task; use ``prefix_counts`` to keep them.
    Nulls, repeated rows, empty tables and other columns as there.
    """
    path = path or default_path()

    def run(source):
        counter = prefix_counter(path)
        for batch in source:
            n_bytes, n_tokens, fitting = [], [], []
            for text in batch["text"]:
                text = text.as_py()
                counts = counter.counts(text)
                n_bytes.append(len(text.encode()))
                n_tokens.append(int(counts[-1]))
                fitting.append(fitting_prefix(counts, limit))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([n > limit for n in n_tokens], pa.bool_()),
                    pa.array(fitting, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_chars"],
            )

    rows = thin(df, id_col, text_col)
    kind = id_type(rows, "doc_id").simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long",
    )
