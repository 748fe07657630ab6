"""Token counts by dynamic programming over a trie of distinct pre-tokens.

Pre-tokens that a worker has not met are inserted in a trie; the forward pass runs once for each
node, that is once for each shared prefix, and the counts of terminal nodes are kept. Two forward passes
share the walk: the unigram one keeps the best score over the pieces that may end a prefix, the merge one
the single last token that byte-pair merging leaves there (see pieces). The public vocabulary is byte-pair
encoded, so its own counts are those of the merge pass: n_tokens; n_unigram is the unigram count.
One pass over the texts without a shuffle; a text costs its pre-tokens, a pre-token its new suffix.
"""

from __future__ import annotations

import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches
from .pieces import UNKNOWN, Vocabulary, pre_tokens

#: Pre-tokens a worker remembers, pairs of tokens too, and how many pre-tokens go into one trie: bounds of memory, not of what is counted.
_MEMORY, _AGREES, _TRIE = 1_200_000, 1_000_000, 20_000


class TrieCounter:
    """log_probs: unigram scores of pieces; by default Zipf's law over the vocabulary's merge ranks."""

    def __init__(self, vocabulary: Vocabulary, log_probs: dict[str, float] | None = None) -> None:
        self.vocabulary = vocabulary
        self.log_probs = log_probs or {p: -math.log(2 - s) for p, s in vocabulary.scores.items()}
        self.floor = min(self.log_probs.values()) - 10
        #: endings of pieces with the piece's id, or -1 if the ending is no piece: the walk back from a prefix's end stops where no piece goes on
        self.endings = dict.fromkeys((p[k:] for p in vocabulary.ids for k in range(len(p))), -1) | vocabulary.ids
        self.scores = [self.log_probs.get(p, 0.0) for p in vocabulary.pieces]
        self.agrees: dict[tuple[int | None, int], bool] = {}
        self.index: dict[str, int] = {}
        self.tables = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def count_words(self, words: list[str]) -> tuple[list[int], list[int]]:
        """(merge count, unigram count) of each of the words, all distinct.

        The trie is held as its words in order, each with the length of the prefix it shares with the one before: the path
        walked keeps the state of that prefix, and each step goes to a node that no word before has reached.
        """
        order = sorted(range(len(words)), key=words.__getitem__)
        merged, unigram = [0] * len(words), [0] * len(words)
        ids, scores, endings, longest = self.vocabulary.ids, self.scores, self.endings, self.vocabulary.longest
        known, ask = self.agrees, self.vocabulary.agrees
        if len(known) > _AGREES:
            known.clear()
        # one entry for each depth of the path walked: last token and count of the merge pass, score and count of the unigram pass
        last: list[int | None] = [None]
        n_merged, best, n_best = [0], [0.0], [0]
        before_word = ""
        for i in order:
            word = words[i]
            common, most = 0, min(len(before_word), len(word))
            while common < most and before_word[common] == word[common]:
                common += 1
            for column in (last, n_merged, best, n_best):
                del column[common + 1 :]
            before_word = word
            for depth in range(common + 1, len(word) + 1):
                char = word[depth - 1]
                if char not in ids:
                    n = len(char.encode("utf-8", "surrogatepass"))
                    last.append(UNKNOWN)
                    n_merged.append(n_merged[-1] + n)
                    best.append(best[-1] + n * self.floor)
                    n_best.append(n_best[-1] + n)
                    continue
                top, fewest, found, token, count = -math.inf, 0, False, None, 0
                for before in range(depth - 1, max(-1, depth - 1 - longest), -1):
                    piece = endings.get(word[before:depth])
                    if piece is None:
                        break
                    if piece < 0:
                        continue
                    score = best[before] + scores[piece]
                    if score >= top:
                        top, fewest = score, n_best[before] + 1
                    if not found:
                        key = (last[before], piece)
                        found = known.get(key)
                        if found is None:
                            found = known[key] = ask(*key)
                        if found:
                            token, count = piece, n_merged[before] + 1
                last.append(token)
                n_merged.append(count)
                best.append(top)
                n_best.append(fewest)
            merged[i], unigram[i] = n_merged[-1], n_best[-1]
        return merged, unigram

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pre-tokens, tokens and unigram tokens of each text; null has none."""
        words = [pre_tokens(t, self.vocabulary) if t else [] for t in texts]
        if len(self.index) > _MEMORY:
            self.index, self.tables = {}, [np.empty(0, np.int64), np.empty(0, np.int64)]
        new = sorted(set(chain.from_iterable(words)) - self.index.keys())
        for at in range(0, len(new), _TRIE):
            part = new[at : at + _TRIE]
            counts = self.count_words(part)
            self.index.update(zip(part, range(len(self.index), len(self.index) + len(part)), strict=True))
            self.tables = [np.concatenate([t, np.array(c, dtype=np.int64)]) for t, c in zip(self.tables, counts, strict=True)]
        per_text = np.array([len(own) for own in words], dtype=np.int64)
        which = np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), dtype=np.int64, count=int(per_text.sum()))
        at = np.concatenate([[0], np.cumsum(per_text)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(t[which])])[at]) for t in self.tables]
        return per_text, sums[0], sums[1]


_counters: dict[tuple, TrieCounter] = {}

COUNTED = pa.schema([("doc_id", pa.int64()), ("n_pre_tokens", pa.int64()), ("n_tokens", pa.int64()), ("n_unigram", pa.int64())])


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_pre_tokens, n_tokens and n_unigram of every whole text.

    Null and empty texts count 0; null ids stay; repeated rows each give a row; an empty table gives none;
    no other column is read. Of segmentations with equal unigram scores the one with the longest last piece counts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the size of the vocabulary file, whatever the data

    def start():
        name = shared.value.name
        counter = _counters.get(name) or _counters.setdefault(name, TrieCounter(shared.value))

        def f(batch):
            return [batch.column(0), *counter.count(batch.column(1).to_pylist())]

        return f

    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text"), COUNTED, start)
