"""SentencePiece encoding and decoding by vectorised merge rounds.

All segments of a batch that are not yet known are laid out in one flat numpy array of symbols.
Each round takes the least pair rank of every segment (a segmented minimum), merges that pair at
its leftmost place, or at all places that do not overlap where no new pair could come first, and
compacts the array, until no segment has a pair left. Decoding gathers the bytes of the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches
from tidelog.llm.piece_bpe import LONG_SEGMENT, SPACE, PieceVocab, code_points, default_model, vocabulary

NONE = np.int32(2**31 - 1)
LEARN_CHARS = 1 << 18
REMEMBERED = 1 << 17  # segments that a worker keeps; beyond it, the memory is emptied


class MergeRounds:
    """Encoder and decoder over one vocabulary. Symbols are piece ids; a character that is no
    piece is given an id beyond the vocabulary, which never merges."""

    def __init__(self, vocab: PieceVocab):
        self.vocab = vocab
        ids, size = vocab.ids, vocab.size
        rows = [(ids[a], ids[b], r, ids[a + b]) for (a, b), r in vocab.pairs.items() if a in ids and b in ids]
        left, right, rank, merged = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        self._build(left * size + right, rank.astype(np.int32), merged.astype(np.int32))
        # A rank is calm if no pair that its merge can make comes before or with it: then all
        # places of the pair in a segment may merge in the same round.
        calm = np.ones(int(rank.max()) + 1, bool)
        piece_rank = np.full(size, NONE, np.int64)
        piece_rank[merged] = rank
        for part in (left, right):
            early = rank <= piece_rank[part]
            calm[piece_rank[part][early & (piece_rank[part] < NONE)]] = False
        _, shared = np.unique([vocab.rank[p] for p in ids], return_counts=True)
        calm[np.unique([vocab.rank[p] for p in ids])[shared > 1].clip(max=len(calm) - 1)] = False
        self._calm = calm
        self._char = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self._char[ord(piece)] = i
        self._char[ord(" ")] = ids[SPACE]
        self._bytes = np.frombuffer(b"".join(vocab.piece_bytes), np.uint8)
        self._len = np.array([len(b) for b in vocab.piece_bytes], np.int64)
        self._at = np.concatenate([[0], np.cumsum(self._len)])
        self.memory: dict[str, bytes] = {}  # of a segment: its ids as int32

    def _build(self, keys: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> None:
        """An open-addressing table of pairs with few enough entries that probes stay short."""
        bits = int(np.ceil(np.log2(len(keys)))) + 3
        self._shift, slots = np.uint64(64 - bits), 1 << bits
        table = np.full(slots, -1, np.int64)
        at = self._slot(keys)
        todo, self._probes = np.arange(len(keys)), 0
        self._rank, self._merged = np.full(slots, NONE, np.int32), np.full(slots, -1, np.int32)
        while len(todo):
            self._probes += 1
            place = (at[todo] + self._probes - 1) % slots
            free = table[place] < 0
            _, first = np.unique(place, return_index=True)
            win = np.zeros(len(todo), bool)
            win[first] = True
            win &= free
            table[place[win]] = keys[todo[win]]
            self._rank[place[win]] = rank[todo[win]]
            self._merged[place[win]] = merged[todo[win]]
            todo = todo[~win]
        self._table = table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, or -1."""
        size = self.vocab.size
        keys = left.astype(np.int64) * size + right
        keys[(left >= size) | (right >= size)] = -2
        at = self._slot(keys)
        found = np.where(self._table[at] == keys, at, -1)
        for k in range(1, self._probes):
            miss = np.nonzero(found < 0)[0]
            if not len(miss):
                break
            place = (at[miss] + k) % len(self._table)
            hit = self._table[place] == keys[miss]
            found[miss[hit]] = place[hit]
            open_slots = self._table[(at[miss] + k - 1) % len(self._table)] < 0
            found[miss[open_slots & ~hit]] = -3  # an empty slot ends the probe
        return np.maximum(found, -1)

    def encode_segments(self, segments: list[str]) -> list[np.ndarray]:
        """Ids of each segment."""
        size = self.vocab.size
        points, lengths = code_points(segments)
        sym = self._char[points]
        unknown = sym < 0
        sym = np.where(unknown, size + points.astype(np.int32), sym)
        word = np.repeat(np.arange(len(segments), dtype=np.int32), lengths)
        done_sym, done_word = [], []

        def pair_slots(at: np.ndarray) -> np.ndarray:
            out = np.full(len(at), -1, np.int64)
            inside = at + 1 < len(sym)
            i = at[inside]
            same = word[i] == word[i + 1]
            got = np.full(len(i), -1, np.int64)
            got[same] = self._find(sym[i[same]], sym[i[same] + 1])
            out[inside] = got
            return out

        slot = pair_slots(np.arange(len(sym)))
        while len(sym):
            rank = np.where(slot >= 0, self._rank[slot], NONE)
            starts = np.nonzero(np.r_[True, word[1:] != word[:-1]])[0]
            least = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(sym)])
            if (least == NONE).any():  # these segments are finished
                over = np.repeat(least == NONE, counts)
                done_sym.append(sym[over])
                done_word.append(word[over])
                keep = ~over
                sym, word, slot, rank = sym[keep], word[keep], slot[keep], rank[keep]
                counts, least = counts[least != NONE], least[least != NONE]
                if not len(sym):
                    break
                starts = np.r_[0, np.cumsum(counts)[:-1]]
            each = np.repeat(least, counts)
            take = rank == each
            index = np.arange(len(sym))
            first = np.minimum.reduceat(np.where(take, index, len(sym)), starts)
            merge = np.zeros(len(sym), bool)
            merge[first] = True
            many = take & self._calm[each]
            many &= ~merge
            if many.any():
                # in a chain of overlapping places, every second one from its left end
                cand = np.nonzero(take & self._calm[each])[0]
                head = np.r_[True, np.diff(cand) > 1]
                run = np.maximum.accumulate(np.where(head, np.arange(len(cand)), 0))
                merge[cand[(np.arange(len(cand)) - run) % 2 == 0]] = True
            at = np.nonzero(merge)[0]
            sym = sym.copy()
            sym[at] = self._merged[slot[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            sym, word, slot = sym[keep], word[keep], slot[keep]
            fresh = moved[at]
            stale = np.unique(np.r_[fresh, np.maximum(fresh - 1, 0)])
            slot[stale] = pair_slots(stale)
        if not done_sym:
            return [np.empty(0, np.int32) for _ in segments]
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        if (sym >= size).any():
            sym, word = self._fall_back(sym, word)
        ends = np.cumsum(np.bincount(word, minlength=len(segments)))
        return np.split(sym.astype(np.int32), ends[:-1])

    def _fall_back(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters that are no pieces by the ids of their bytes."""
        parts = [
            [self.vocab.byte_id[b] for b in chr(s - self.vocab.size).encode("utf-8", "replace")] for s in sym[sym >= self.vocab.size]
        ]
        counts = np.ones(len(sym), np.int64)
        counts[sym >= self.vocab.size] = [len(p) for p in parts]
        out = np.repeat(sym, counts)
        out[out >= self.vocab.size] = [b for p in parts for b in p]
        return out, np.repeat(word, counts)

    def learn(self, segments: set[str]) -> None:
        """Encode what is not remembered yet."""
        if len(self.memory) > REMEMBERED:
            self.memory = {}
        new = list(segments.difference(self.memory))
        if new:
            self.memory.update(zip(new, (x.tobytes() for x in self.encode_segments(new)), strict=True))

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text. Segments are learnt together for texts of about LEARN_CHARS characters."""
        waiting, chars = [], 0
        for t in texts:
            waiting.append(self.vocab.segments(t or ""))
            chars += len(t or "")
            if chars > LEARN_CHARS:
                yield from self._joined(waiting)
                waiting, chars = [], 0
        yield from self._joined(waiting)

    def _joined(self, documents: list[list[str]]) -> Iterator[np.ndarray]:
        self.learn(set().union(*documents))
        known = self.memory
        for parts in documents:
            yield np.frombuffer(b"".join(map(known.__getitem__, parts)), np.int32)
        for long in {p for parts in documents for p in parts if len(p) > LONG_SEGMENT}:
            known.pop(long, None)

    def encode(self, text: str | None) -> np.ndarray:
        return next(self.encode_many([text]))

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        lengths = self._len[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        source = np.arange(total) + np.repeat(self._at[ids] - (ends - lengths), lengths)
        out = self._bytes[source].tobytes()
        if len(ids) and self.vocab.piece_bytes[ids[0]].startswith(b" ") and ids[0] in self._spaced:
            out = out[1:]
        return out

    @property
    def _spaced(self) -> set[int]:
        if not hasattr(self, "_spaced_ids"):
            self._spaced_ids = {i for p, i in self.vocab.ids.items() if p.startswith(SPACE)}
        return self._spaced_ids

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(np.asarray(ids, np.int64)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(model_path: str) -> MergeRounds:
    return MergeRounds(vocabulary(model_path))


def encode_column(documents: DataFrame, text: str = "text", ids: str = "ids", model_path: str | None = None) -> DataFrame:
    """Add the ids of ``text`` as an array column. Null and empty texts have no ids. Other columns
    stay; one already named like ``ids`` is replaced."""
    path = model_path or default_model()

    @F.pandas_udf("array<int>")
    def encode(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = codec(path)
        for batch in texts:
            yield pd.Series(list(coder.encode_many(batch)))

    return bounded_batches(documents).withColumn(ids, encode(F.col(text)))


def decode_column(encoded: DataFrame, ids: str = "ids", text: str = "decoded", model_path: str | None = None) -> DataFrame:
    """Add the text of an array of ids; null ids give the empty text."""
    path = model_path or default_model()

    @F.pandas_udf("string")
    def decode(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = codec(path)
        for batch in values:
            yield pd.Series([coder.decode([] if v is None else v) for v in batch])

    return bounded_batches(encoded).withColumn(text, decode(F.col(ids)))


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text", model_path: str | None = None) -> DataFrame:
    """Encode and decode every whole text and return, per document, the number of ids and the
    SHA-256 of the ids (decimal, comma-joined) and of the decoded text.

    Null and empty texts have no ids and decode to the empty text. Repeated keys give a row each.
    The plan is one scan and one Python step; nothing is shuffled."""
    path = model_path or default_model()
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = codec(path)
        names = np.array([str(i) for i in range(coder.vocab.size)], object)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for ids in coder.encode_many(batch["_text"]):
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(names[ids]).encode()).hexdigest())
                of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pd.DataFrame({key: batch["_key"].array, "n_tokens": counts, "ids_sha256": of_ids, "decoded_sha256": of_text})
        coder.memory = {}  # the worker goes on to other tasks

    rows = bounded_batches(documents).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInPandas(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
