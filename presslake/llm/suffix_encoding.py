"""SentencePiece encoding and decoding by suffix-array matching.

In each batch the distinct pre-tokens not met before are laid end to end; a suffix array (prefix
doubling, as deep as the longest piece) indexes them; every piece is binary-searched for the range of
suffixes that start with it; each occurrence is an edge from its first to behind its last character.
The edges, sorted by position, are relaxed left to right. One pass over the texts, no shuffle; what a
worker keeps (ids of pre-tokens) is bounded and only saves work.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema

from .common import map_batches
from .pieces import MARK, UNKNOWN, Vocabulary, pre_tokens

#: Pre-tokens a worker remembers before it starts afresh.
_MEMORY = 300_000
#: Pairs of pieces a worker remembers the agreement of.
_PAIRS = 600_000
#: Pre-tokens indexed together: a bound of memory, each is looked up among all pieces in any case.
_INDEXED = 30_000
_BORDER = 0x110000
_START = -2


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first `depth` (or a few more) codes.

    As many codes as fit are packed into the first sort key; prefix doubling goes on from there.
    """
    kinds, rank = np.unique(codes, return_inverse=True)
    rank = rank.astype(np.int64).ravel() + 1
    bits = int(len(kinds)).bit_length()
    length = max(1, min(depth, 62 // bits))
    padded = np.concatenate([rank, np.zeros(length, dtype=np.int64)])
    key = np.zeros_like(rank)
    for k in range(length):
        key = (key << bits) | padded[k : k + len(rank)]
    while length < depth:
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64).ravel() + 1
        behind = np.zeros_like(rank)
        behind[:-length] = rank[length:]
        key = rank * (rank.max() + 1) + behind
        length *= 2
    return np.argsort(key)


def occurrences(codes: np.ndarray, order: np.ndarray, pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each piece the range [low, high) of suffixes in order that start with it; all are searched at once, code by code."""
    lengths = np.array([len(p) for p in pieces])
    table = np.zeros((len(pieces), lengths.max()), dtype=np.int64)
    for row, p in zip(table, pieces, strict=True):
        row[: len(p)] = p
    low, high = np.zeros(len(pieces), dtype=np.int64), np.full(len(pieces), len(order), dtype=np.int64)
    padded = np.concatenate([codes, np.full(table.shape[1], _BORDER + 1, dtype=codes.dtype)])

    def bound(lo: np.ndarray, hi: np.ndarray, code: np.ndarray, depth: int, behind: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) >> 1
            found = padded[order[np.minimum(mid, len(order) - 1)] + depth]
            right = open_ & ((found <= code) if behind else (found < code))
            hi = np.where(open_ & ~right, mid, hi)
            lo = np.where(right, mid + 1, lo)
        return lo

    for depth in range(table.shape[1]):
        active = np.flatnonzero((lengths > depth) & (low < high))
        if not len(active):
            break
        lo, hi, code = low[active], high[active], table[active, depth]
        low[active] = bound(lo, hi, code, depth, False)
        high[active] = bound(lo, hi, code, depth, True)
    return low, high


class Encoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.piece_ids = np.array(list(vocabulary.ids.values()), dtype=np.int64)
        self.piece_codes = [np.array(list(map(ord, p)), dtype=np.int64) for p in vocabulary.ids]
        self.piece_lengths = np.array([len(p) for p in vocabulary.ids])
        spelt = [p.replace(MARK, " ").encode() if p in vocabulary.ids else b"" for p in vocabulary.pieces]
        for value, i in enumerate(vocabulary.byte_ids):
            spelt[i] = bytes([value])
        self.spelt = spelt
        self.known: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All edges (from, to, id) of the indexed codes."""
        order = suffix_array(codes, self.vocabulary.longest)
        low, high = occurrences(codes, order, self.piece_codes)
        counts = high - low
        which = np.repeat(np.arange(len(counts)), counts)
        starts = order[np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)]
        return starts, starts + self.piece_lengths[which], self.piece_ids[which]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words (distinct pre-tokens without newlines) end to end, and how many each has."""
        text = "\n".join(words) + "\n"  # a border: no piece holds a newline
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        lengths = np.array(list(map(len, words)))
        firsts = np.cumsum(lengths + 1) - lengths - 1
        first_of = np.repeat(firsts, lengths + 1)
        starts, ends, ids = self.edges(codes)
        plain = np.zeros(len(codes), dtype=bool)
        plain[starts[ends == starts + 1]] = True
        alone = np.flatnonzero(~plain & (codes != 10))  # characters without a piece are steps of their own
        starts, ends, ids = np.concatenate([starts, alone]), np.concatenate([ends, alone + 1]), np.concatenate([ids, np.full(len(alone), UNKNOWN)])
        # last and back of each position: the token that ends the best way there, and where it began
        last, back = np.full(len(codes) + 1, _START, dtype=np.int64), np.zeros(len(codes) + 1, dtype=np.int64)
        steps = ends - first_of[starts]
        by = np.argsort(steps.astype(np.uint16), kind="stable") if steps.max() < 2**16 else np.argsort(steps, kind="stable")
        starts, ends, ids = starts[by], ends[by], ids[by]
        borders = np.flatnonzero(np.diff(steps[by], prepend=-1, append=-1))
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            fits = self._agreeing(last[starts[a:b]], ids[a:b])  # one step further in all words at once
            last[ends[a:b][fits]] = ids[a:b][fits]
            back[ends[a:b][fits]] = starts[a:b][fits]
        # back from the ends of all words at once; in order of position the marked steps are the tokens
        marked = np.zeros(len(codes) + 1, dtype=bool)
        at, begins = firsts + lengths, firsts
        while len(at):
            marked[at] = True
            at = back[at]
            within = at > begins
            at, begins = at[within], begins[within]
        steps = np.flatnonzero(marked)
        tokens, counts = last[steps], np.ones(len(steps), dtype=np.int64)
        for k in np.flatnonzero(tokens == UNKNOWN).tolist():
            counts[k] = len(self.vocabulary.spelt(text[steps[k] - 1]))
        ids = np.repeat(tokens, counts)
        at = np.cumsum(counts) - counts
        for k in np.flatnonzero(tokens == UNKNOWN).tolist():
            ids[at[k] : at[k] + counts[k]] = self.vocabulary.spelt(text[steps[k] - 1])
        return ids.astype(np.int32), np.bincount(np.searchsorted(firsts, steps - 1, side="right") - 1, weights=counts, minlength=len(words)).astype(np.int64)

    def _agreeing(self, last: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Vocabulary.agrees of each pair, asked once for each distinct pair. An edge from the start of a word has last _START."""
        width = len(self.vocabulary.pieces) + 2
        keys, inverse = np.unique((last + 2) * width + ids + 2, return_inverse=True)
        if len(self.known) > _PAIRS:
            self.known.clear()
        known, agrees = self.known, self.vocabulary.agrees
        answers = np.empty(len(keys), dtype=bool)
        for i, key in enumerate(keys.tolist()):
            answer = known.get(key)
            if answer is None:
                before, piece = key // width - 2, key % width - 2
                answer = known[key] = agrees(None if before == _START else before, piece)
            answers[i] = answer
        return answers[inverse.ravel()]

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and for each text where its ids start (one more at the end). Null gives none."""
        words = [pre_tokens(t, self.vocabulary) if t else [] for t in texts]
        if len(self.index) > _MEMORY:
            self._forget()
        new = list(set(chain.from_iterable(words)) - self.index.keys() - {"\n"})
        if "\n" not in self.index:
            self._add(["\n"], np.array([self.vocabulary.byte_ids[10]], dtype=np.int32), np.array([1]))
        for at in range(0, len(new), _INDEXED):
            self._add(new[at : at + _INDEXED], *self.encode_words(new[at : at + _INDEXED]))
        per_text = np.array([len(own) for own in words], dtype=np.int64)
        which = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(per_text.sum()))
        lengths = self.lengths[which]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(self.starts[which] - total[:-1], lengths) + np.arange(total[-1])]
        return ids, total[np.concatenate([[0], np.cumsum(per_text)])]

    def decode(self, ids: np.ndarray) -> str:
        """The text that ids stand for; bytes that are no UTF-8 become U+FFFD, the mark in front goes."""
        spelt = self.spelt
        text = b"".join([spelt[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_encoders: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One for each worker process, so that tasks share what it remembers."""
    if vocabulary.name not in _encoders:
        _encoders[vocabulary.name] = Encoder(vocabulary)
    return _encoders[vocabulary.name]


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])


def encode(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids of every whole text, round_trip (whether decoding the ids gives the text again) and the columns of keep as they are.

    A literal U+2581 is the vocabulary's space mark and decodes to a space; round_trip allows for that
    alone. Null text has null ids, 0 tokens and a null round_trip; empty text has no ids. Null doc_ids stay, repeated rows each give a row, an
    empty table gives none; no other column is read, and none of keep may bear the name of an output.
    """
    if clash := {*keep} & {f.name for f in ENCODED}:
        raise ValueError(f"columns that the encoding makes itself: {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the size of the vocabulary file, whatever the data

    def start():
        encoder = _encoder(shared.value)

        def f(batch):
            texts = batch.column(1).to_pylist()
            ids, at = encoder.encode(texts)
            null = [t is None for t in texts]
            good = [None if t is None else encoder.decode(ids[a:b]) == t.replace(MARK, " ") for t, a, b in zip(texts, at[:-1], at[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids), mask=pa.array(null))
            return [batch.column(0), np.diff(at), lists, good, *batch.columns[2:]]

        return f

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", *keep)
    return map_batches(rows, pa.schema([*ENCODED, *to_arrow_schema(rows.select(*keep).schema)]), start)


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of rows(doc_id, ids); null ids give null text."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def start():
        encoder = _encoder(shared.value)

        def f(batch):
            return [batch.column(0), [None if x is None else encoder.decode(np.array(x, dtype=np.int64)) for x in batch.column(1).to_pylist()]]

        return f

    return map_batches(rows.select(rows["doc_id"].cast("long").alias("doc_id"), "ids"), pa.schema([("doc_id", pa.int64()), ("text", pa.string())]), start)
