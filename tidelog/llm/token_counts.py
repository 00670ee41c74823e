"""Token counts by a compiled finite-state transducer.

The last token of the encoding of every prefix determines the encoding: a token ``t`` ends the
encoding of a prefix exactly if it is a suffix of it and the pair (last token before it, ``t``) is
left as it is when the two are encoded together. Only as many earlier positions matter as the
longest suffix that some longer token starts with, so the memory is finite and the encoder is a
deterministic transducer over characters. Each transition carries how many tokens it adds (it may
be negative, when a character lets earlier tokens merge). States and transitions are made when a
text first asks for them.

A text is cut into chunks. A chunk's state map gives, for every entry state that can reach it, the
exit state and the tokens emitted; maps compose associatively. A chunk that begins where no token
can cross has one entry state only, and what it emits is remembered. In a long run without such a
place every chunk's map is made side by side (one numpy step per character column), over the states
in which the text before it can end, and the maps are composed by a parallel prefix scan, doubling
its reach in each step.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches
from tidelog.llm.piece_bpe import LONG_SEGMENT, SPACE, PieceVocab, code_points, default_model, vocabulary

UNMADE = -1
REMEMBERED = 1 << 19
TABLE_CELLS = 1 << 25  # the transition table starts anew beyond this
LEARN_CHARS = 1 << 20
LOOK_BACK = 16  # characters before a chunk from each of which the machine is started for its entry states


class NotFinite(ValueError):
    """The pair rule does not decide the last token, so the transducer cannot count."""


class CountTransducer:
    def __init__(self, vocab: PieceVocab):
        self.vocab = vocab
        self.starts = {p[:k] for p in vocab.ids for k in range(1, len(p))}
        self.stays: dict[tuple[str, str], bool] = {}
        self.memory: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        start = ("", ("",), (0,))
        self.numbers = {start: 0}
        self.states = [start]
        self.symbols: list[str] = []
        self.symbol_of = np.full(0x110000, UNMADE, np.int32)
        self.next = np.full((256, 64), UNMADE, np.int32)
        self.adds = np.zeros((256, 64), np.int8)

    def _stay(self, before: str, token: str) -> bool:
        """Whether encoding the two together gives the two."""
        key = (before, token)
        if key not in self.stays:
            whole = [before, token] if before else [token]
            self.stays[key] = self.vocab.merge(before + token) == whole
        return self.stays[key]

    def _make(self, state: int, symbol: int) -> None:
        """Fill one transition."""
        c = self.symbols[symbol]
        if c not in self.vocab.chars:  # its bytes are tokens, and nothing merges across it
            self.next[state, symbol], self.adds[state, symbol] = 0, len(c.encode("utf-8", "replace"))
            return
        tail, last, since = self.states[state]
        tail += c
        ends = [
            k
            for k in range(1, len(tail) + 1)
            if (k == 1 or tail[-k:] in self.vocab.ids) and last[k - 1] is not None and self._stay(last[k - 1], tail[-k:])
        ]
        if len(ends) != 1:
            raise NotFinite(f"the pair rule gives {len(ends)} last tokens for {tail!r}")
        k = ends[0]
        added = 1 - since[k - 1]
        keep = next((d for d in range(len(tail), 0, -1) if tail[-d:] in self.starts), 0)
        needed = [tail[-d:] in self.starts for d in range(1, keep + 1)]  # where a longer token may have begun
        earlier = tuple(t if n else None for t, n in zip(last, needed, strict=False))
        gained = tuple(added + s if n else 0 for s, n in zip(since, needed, strict=False))
        target = (tail[len(tail) - keep :], (tail[-k:], *earlier), (0, *gained))
        number = self.numbers.setdefault(target, len(self.states))
        if number == len(self.states):
            self.states.append(target)
            if number == len(self.next):
                self.next = np.concatenate([self.next, np.full_like(self.next, UNMADE)])
                self.adds = np.concatenate([self.adds, np.zeros_like(self.adds)])
        self.next[state, symbol], self.adds[state, symbol] = number, added

    def _symbols(self, points: np.ndarray) -> np.ndarray:
        out = self.symbol_of[points]
        for p in np.unique(points[out == UNMADE]):
            self.symbol_of[p] = len(self.symbols)
            self.symbols.append(SPACE if chr(p) == " " else chr(p))
            if len(self.symbols) > self.next.shape[1]:
                self.next = np.concatenate([self.next, np.full_like(self.next, UNMADE)], axis=1)
                self.adds = np.concatenate([self.adds, np.zeros_like(self.adds)], axis=1)
        return self.symbol_of[points]

    def run(self, chunks: list[str], entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state maps of the chunks at their entry states: exit states and tokens added."""
        points, lengths = code_points(chunks)
        symbols = self._symbols(points)
        order = np.argsort(-lengths, kind="stable")
        at, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
        state, total = entry[order].astype(np.int32), np.zeros(len(chunks), np.int64)
        for column in range(int(sizes[0]) if len(sizes) else 0):
            live = np.searchsorted(-sizes, -column, side="left")
            s, c = state[:live], symbols[at[:live] + column]
            target = self.next[s, c]
            if (target == UNMADE).any():
                missing = target == UNMADE
                for a, b in np.unique(np.stack([s[missing], c[missing]]), axis=1).T:
                    self._make(int(a), int(b))
                target = self.next[s, c]
            total[:live] += self.adds[s, c]
            state[:live] = target
        exits, counts = np.empty_like(state), np.empty_like(total)
        exits[order], counts[order] = state, total
        return exits, counts

    def state_maps(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The maps of chunks that follow one another, as matrices: for the k-th entry state of a chunk,
        which entry state of the next chunk it leaves in, and how many tokens it adds. The first
        chunk's only entry state is 0. Entry states are those in which a machine started at any of
        the last LOOK_BACK characters leaves the chunk before, and all that the maps lead to."""
        entries: list[dict[int, int]] = [{0: 0}, *({} for _ in chunks)]
        before = [(i + 1, c[-k:]) for i, c in enumerate(chunks) for k in range(1, min(LOOK_BACK, len(c)) + 1)]
        leaves, _ = self.run([c for _, c in before], np.zeros(len(before), np.int32))
        for (i, _), state in zip(before, leaves.tolist(), strict=True):
            entries[i].setdefault(state, len(entries[i]))
        results: list[dict[int, tuple[int, int]]] = [{} for _ in chunks]
        waiting = [(i, e) for i, states in enumerate(entries[:-1]) for e in states]
        while waiting:
            exits, counts = self.run([chunks[i] for i, _ in waiting], np.array([e for _, e in waiting], np.int32))
            new = []
            for (i, e), x, n in zip(waiting, exits.tolist(), counts.tolist(), strict=True):
                if x not in entries[i + 1]:
                    entries[i + 1][x] = len(entries[i + 1])
                    if i + 1 < len(chunks):
                        new.append((i + 1, x))
                results[i][entries[i][e]] = (entries[i + 1][x], n)
            waiting = new
        width = max(map(len, entries))
        to, adds = np.zeros((len(chunks), width), np.int64), np.zeros((len(chunks), width), np.int64)
        for i, found in enumerate(results):
            for k, (x, n) in found.items():
                to[i, k], adds[i, k] = x, n
        return to, adds

    def scan(self, chunks: list[str]) -> np.ndarray:
        """The tokens of a run of chunks up to the end of each: the prefixes of the composition of
        their maps, in as many steps as the logarithm of their number."""
        to, adds = self.state_maps(chunks)
        reach = 1
        while reach < len(chunks):
            first, second = to[:-reach], to[reach:]
            later = np.take_along_axis(adds[reach:], first, axis=1)
            to, adds = np.r_[to[:reach], np.take_along_axis(second, first, axis=1)], np.r_[adds[:reach], adds[:-reach] + later]
            reach *= 2
        return adds[:, 0]

    def plain_count(self, segment: str) -> int:
        """The tokens of a segment by merging it."""
        chars = self.vocab.chars
        return sum(1 if len(t) > 1 or t in chars else len(t.encode("utf-8", "replace")) for t in self.vocab.merge(segment.replace(" ", SPACE)))

    def learn(self, segments: set[str]) -> None:
        if len(self.memory) > REMEMBERED:
            self.memory = {}
        if self.next.size > TABLE_CELLS:
            self._reset()
        new = list(segments.difference(self.memory))
        if not new:
            return
        try:
            short = [s for s in new if len(s) <= LONG_SEGMENT]
            if short:
                _, counts = self.run(short, np.zeros(len(short), np.int32))
                self.memory.update(zip(short, counts.tolist(), strict=True))
            for s in (s for s in new if len(s) > LONG_SEGMENT):
                chunks = [s[i : i + LONG_SEGMENT] for i in range(0, len(s), LONG_SEGMENT)]
                self.memory[s] = int(self.scan(chunks)[-1])
        except NotFinite:
            self.memory.update((s, self.plain_count(s)) for s in new)

    def count_many(self, texts) -> list[int]:
        out: list[int] = []
        waiting, chars = [], 0
        for t in texts:
            waiting.append(self.vocab.segments(t or ""))
            chars += len(t or "")
            if chars > LEARN_CHARS:
                out += self._counted(waiting)
                waiting, chars = [], 0
        return out + self._counted(waiting)

    def _counted(self, documents: list[list[str]]) -> list[int]:
        self.learn(set().union(*documents))
        known = self.memory
        out = [sum(map(known.__getitem__, parts)) for parts in documents]
        for long in {p for parts in documents for p in parts if len(p) > LONG_SEGMENT}:
            known.pop(long, None)
        return out


@lru_cache(maxsize=2)
def transducer(model_path: str) -> CountTransducer:
    return CountTransducer(vocabulary(model_path))


def count_tokens(
    documents: DataFrame, key: str = "doc_id", text: str = "text", limit: int = 4096, model_path: str | None = None
) -> DataFrame:
    """Per document: its UTF-8 bytes, its tokens, and whether they are more than ``limit``.

    Null and empty texts have no bytes and no tokens; repeated keys give a row each; other columns
    are ignored. One scan and one Python step, without a shuffle."""
    path = model_path or default_model()
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = transducer(path)
        for b in batches:
            yield pd.DataFrame({key: b["_key"].array, "n_bytes": b["_bytes"].array, "n_tokens": machine.count_many(b["_text"])})
        machine.memory = {}  # the machine stays for the worker's next task

    rows = bounded_batches(documents).select(
        F.col(key).alias("_key"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("_bytes"),
        F.col(text).alias("_text"),
    )
    counted = rows.mapInPandas(run, f"`{key}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
