"""The vocabulary of a sentencepiece BPE model, and what a text falls into before any merge.

A text is cut into *segments* that no piece can cross, so each segment may be encoded by itself:
before a space that follows something else, and around every character that no piece contains.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

SPACE = "▁"  # how the model writes a space
LONG_SEGMENT = 64  # longer segments are not remembered


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceVocab:
    """Pieces, ranks (0 merges first; equal scores share a rank) and merge pairs of one model."""

    def __init__(self, model_path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = sp.get_piece_size()
        self.size = size
        self.byte_id: dict[int, int] = {}
        self.piece_bytes: list[bytes] = []
        self.ids: dict[str, int] = {}
        scores: dict[str, float] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.piece_bytes.append(bytes([value]))
            elif sp.is_control(i):
                self.piece_bytes.append(b"")
            elif sp.is_unknown(i):
                self.piece_bytes.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                scores[piece] = sp.get_score(i)
                self.piece_bytes.append(piece.replace(SPACE, " ").encode())
        if len(self.byte_id) != 256:
            raise ValueError("the model has no byte fallback")
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids):
            raise ValueError("a piece holds a space after other characters, so segments would not be independent")
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in scores.items()}
        self.max_piece = max(map(len, self.ids))
        self.chars = {c for p in self.ids for c in p}
        self.pairs = {
            (p[:k], p[k:]): self.rank[p]
            for p in self.ids
            for k in range(1, len(p))
            if self._symbol(p[:k]) and self._symbol(p[k:])
        }
        newline = "" if "\n" in self.chars else "\n"
        self.newline = newline
        self._cut = re.compile(f" *[^ {newline}]+|{newline}| +" if newline else " *[^ ]+| +")

    def _symbol(self, s: str) -> bool:
        """A character by itself is a symbol even where it is no piece."""
        return s in self.ids or len(s) == 1

    def segments(self, text: str) -> list[str]:
        """Segments of a text, with plain spaces; the model's leading space is part of the first."""
        if not text:
            return []
        return self._cut.findall(" " + text.replace(SPACE, " "))

    def merge(self, text: str) -> list[str]:
        """The symbols of one segment by repeated best merge, leftmost first: for short strings."""
        s = list(text)
        pairs = self.pairs
        while len(s) > 1:
            best, at = None, -1
            for i in range(len(s) - 1):
                r = pairs.get((s[i], s[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            s[at : at + 2] = [s[at] + s[at + 1]]
        return s


@lru_cache(maxsize=2)
def vocabulary(model_path: str) -> PieceVocab:
    return PieceVocab(model_path)


def code_points(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the strings one after another, and the strings' lengths."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    flat = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, lengths
