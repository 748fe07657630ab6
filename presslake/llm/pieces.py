"""A public SentencePiece vocabulary: its pieces, scores and the facts that encoding by edges rests on.

The public model is byte-pair encoding with byte fallback, without normalisation. Merging never
joins across some borders (before a space mark that follows another character, around a newline), so
texts are cut there into pre-tokens, which repeat a lot. Inside a pre-token the merge result has this
property: every two neighbouring tokens, taken alone, merge to just these two; and only one sequence
of tokens has it. So the last token of each prefix is the one piece that agrees with the last token of
the prefix it leaves - which lets forward passes over positions or trie nodes give the exact result.
"""

from __future__ import annotations

import re
import string
from functools import lru_cache
from pathlib import Path

MARK = "▁"
#: id that stands for a character without a piece, until it is spelt in bytes.
UNKNOWN = -1


class Vocabulary:
    """pieces[id]; scores of plain pieces by text; byte_ids[value] for byte fallback. Picklable, about a MB, fixed by the model."""

    def __init__(self, pieces: list[str], ids: dict[str, int], scores: dict[str, float], byte_ids: list[int]) -> None:
        self.pieces, self.ids, self.scores, self.byte_ids = pieces, ids, scores, byte_ids
        self.longest = max(map(len, ids))
        self.pattern = _borders(ids)

    def __reduce__(self):
        return Vocabulary, (self.pieces, self.ids, self.scores, self.byte_ids)

    @property
    def name(self) -> tuple:
        return len(self.pieces), hash(tuple(self.pieces))

    def merged(self, text: str) -> list[str]:
        """Plain byte-pair merging: the best-scored neighbouring pair first, the left one on ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agrees(self, last: int | None, piece: int) -> bool:
        """Whether piece may follow the token last (None: start of a pre-token)."""
        if piece == UNKNOWN or last == UNKNOWN:
            last = None
        if piece == UNKNOWN:
            return True
        parts = ([] if last is None else [self.pieces[last]]) + [self.pieces[piece]]
        if last is not None and "".join(parts) in self.ids:
            return False  # the two would merge
        return self.merged("".join(parts)) == parts

    def spelt(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


@lru_cache(maxsize=4)
def load(model: str) -> Vocabulary:
    """Read on the driver, through the library; executors get the object, not the file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=Path(model).read_bytes())
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    plain = [i for i in range(len(pieces)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    byte_ids = [0] * 256
    for i in range(len(pieces)):
        if sp.is_byte(i):
            byte_ids[int(pieces[i][3:5], 16)] = i
    return Vocabulary(pieces, {pieces[i]: i for i in plain}, {pieces[i]: sp.get_score(i) for i in plain}, byte_ids)


def _borders(ids: dict[str, int]) -> re.Pattern:
    """What pre-tokens are: space marks and what follows, up to the next border.

    Nothing merges over a newline (no piece holds one) or before a mark. Nor does it between a letter or
    digit and a punctuation sign, for those signs that no piece has behind one.
    """
    if any("\n" in p or MARK in p.lstrip(MARK) for p in ids):
        raise ValueError("pieces reach over newlines or into a next word")
    behind = {b for p in ids for a, b in zip(p, p[1:], strict=False) if a.isalnum()}
    signs = "".join(map(re.escape, sorted(set(string.punctuation) - behind)))
    if not signs:
        return re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
    other = f"[^{MARK}\n{signs}]"
    return re.compile(f"{MARK}*[{signs}]*{other}+(?:(?<![^\\W_])[{signs}]+{other}*)*|{MARK}*[{signs}]+|{MARK}+|\n")


def pre_tokens(text: str, vocabulary: Vocabulary) -> list[str]:
    """Pre-tokens in order; a space mark stands in front of the text, none for an empty text."""
    return vocabulary.pattern.findall(MARK + text.replace(" ", MARK)) if text else []
