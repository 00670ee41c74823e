"""Removal of repeated byte strings by a hash-compared suffix sort.

A string of ``length`` bytes holds ``length - GRAM + 1`` grams. The one of least hash, leftmost on
ties, is its anchor, and equal strings have it at the same place. So only strings of equal anchors
need comparing, and these are brought together through anchors, about one in 80 bytes:

1. Each anchor gives a row: the hash of its gram, a hash of its context (all bytes of all strings it
   anchors) and its place. Rows of equal contexts are copies of the first of them, which stands for
   them; where a gram has one context only, there is nothing else to compare.
2. The contexts that stand alone in a gram that has several, mostly at the ends of repeats, are sent
   to their gram's group with the first copy of each repeated context there. In a group, the suffixes
   at the same distance from the anchor are merge-sorted; two suffixes are compared through prefix
   polynomial hashes, a binary search giving the length of their common extension. Neighbours that
   agree over ``length`` bytes are repeated; their bytes are compared, so that no collision passes.
3. Where one gram has very many contexts, the group is split further, by string: each of their strings
   is dealt by two hashes, so that no task holds a group that grows with the corpus.
4. Copies of contexts and strings are verified: their bytes, joined to runs, are sent to the document
   of the one that stands for them and compared. If any differ, all is done again with other hashes.
5. Each document is joined with its repeated starts and cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches, discard, hinted, stash

LENGTH = 200
GRAM = 40
CROWD = 2000  # contexts of one gram beyond which its group is split by string
GRAMS_BROADCAST = 1_000_000  # grams, of 9 bytes each, that are broadcast
FLAT_BYTES = 1 << 18  # bytes that are hashed or sorted at a time, whole documents or groups
BASE, BASE2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Further bases, should two strings ever agree in all hashes.
SPARE_BASES = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: A place packs the first start, the anchor's distance from it and the number of starts.
SPAN_BITS, OFF_BITS = 8, 8


def _power_tables(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for x in (base, pow(base, -1, 1 << 64)):
        t = np.full(n + 1, x, np.uint64)
        t[0] = 1
        tables.append(np.multiply.accumulate(t))
    return tables[0], tables[1]


@lru_cache(maxsize=4)
def _kept_tables(base: int) -> tuple[np.ndarray, np.ndarray]:
    return _power_tables(base, 2 * FLAT_BYTES)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n of a base and of its inverse, modulo 2^64; longer tables are not kept."""
    up, down = _kept_tables(base)
    if n >= len(up):
        return _power_tables(base, n)
    return up[: n + 1], down[: n + 1]


class PrefixHashes:
    """Polynomial hashes of all substrings of a byte array, modulo 2^64."""

    def __init__(self, data: np.ndarray, base: int = BASE):
        n = len(data)
        power, self.inverse = powers(base, n)
        spread = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9)) ^ np.uint64(base >> 7)
        spread = (spread ^ (spread >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(spread[data] * power[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self.inverse[start]

    def every(self, size: int) -> np.ndarray:
        """The hash of each substring of one size."""
        return (self.prefix[size:] - self.prefix[:-size]) * self.inverse[: len(self.prefix) - size]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, by running minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors_of(texts: list[bytes], length: int, gram: int = GRAM, base: int = BASE2) -> tuple[np.ndarray, ...]:
    """For all anchors of some texts: text number, gram hash, context hash (by ``base``) and place."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum(sizes)
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = PrefixHashes(data)
    grams = hashes.every(gram)
    low = np.uint64(max(24, int(len(data)).bit_length()))
    ranked = (_mixed(grams) >> low << low) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_least_in_windows(ranked, length - gram + 1) & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    start = np.nonzero(np.arange(len(anchor)) + length <= ends[text])[0]
    if not len(start):
        return none, none, none, none
    a, t = anchor[start], text[start]
    new = np.r_[True, (a[1:] != a[:-1]) | (t[1:] != t[:-1])]
    first = np.nonzero(new)[0]
    span = np.diff(np.r_[first, len(start)])
    lo, a, t = start[first], a[first], t[first]
    context = PrefixHashes(data, base).of(lo, span - 1 + length)
    context = _mixed(context + (span.astype(np.uint64) << np.uint64(32)) + (a - lo).astype(np.uint64))
    place = ((lo - (ends - sizes)[t]) << (SPAN_BITS + OFF_BITS)) | ((a - lo) << SPAN_BITS) | span
    return t, grams[a].view(np.int64), context.view(np.int64), place


def _combine(gram: np.ndarray, context: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many anchors each row stands for, and which row stands for it. Of equal contexts in a batch
    one row stands for all. The others stand for none, and their grams are replaced by a hash of
    their place, so that a gram that is everywhere does not gather its rows in one task."""
    order = np.lexsort((place, doc, context, gram))
    same = np.r_[False, (gram[order][1:] == gram[order][:-1]) & (context[order][1:] == context[order][:-1])] if len(order) else np.empty(0, bool)
    first = np.nonzero(~same)[0]
    times, stands = np.zeros(len(order), np.int32), np.empty(len(order), np.int64)
    counts = np.diff(np.r_[first, len(order)])
    times[order[first]] = counts
    stands[order] = np.repeat(order[first], counts)
    gone = order[same]
    gram[gone] = _mixed(_mixed(doc[gone].view(np.uint64)) + place[gone].view(np.uint64)).view(np.int64)
    return times, stands


def _keyed(documents: DataFrame, key: str, text: str) -> DataFrame:
    """doc and fold: together they tell apart rows that share an id, or have none, by their texts."""
    return bounded_batches(documents).select(
        F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("doc"),
        F.hash(F.col(key).isNull(), F.col(text)).alias("fold"),
        F.col(key).isNull().alias("missing"),
        F.col(text).alias("_text"),
    )


def anchor_rows(documents: DataFrame, key: str, text: str, length: int, base: int) -> DataFrame:
    """gram, context, doc, fold, place, times and, where times is 0, the row that stands for it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            part: list[bytes] = []
            where: list[int] = []
            held = 0

            def rows(part=None, where=None, b=b):
                t, gram, context, place = anchors_of(part, length, base=base)
                at = np.array(where, np.int64)[t]
                doc, fold = b["doc"].to_numpy()[at], b["fold"].to_numpy()[at]
                times, stands = _combine(gram, context, doc, place)
                out = pd.DataFrame({"gram": gram, "context": context, "doc": doc, "fold": fold, "place": place, "times": times})
                for name in ("doc", "fold", "place"):
                    out[f"r_{name}"] = out[name].to_numpy()[stands]
                return out

            for i, t in enumerate(b["_text"]):
                if t is None or len(t) * 4 < length:
                    continue
                part.append(t.encode("utf-8", "replace"))
                where.append(i)
                held += len(part[-1])
                if held > FLAT_BYTES:
                    yield rows(part, where)
                    part, where, held = [], [], 0
            if part:
                yield rows(part, where)

    schema = "gram long, context long, doc long, fold int, place long, times int, r_doc long, r_fold int, r_place long"
    return _keyed(documents, key, text).mapInPandas(run, schema)


def known_anchors(rows: DataFrame) -> DataFrame:
    """Anchors with ``ask`` (no other has the context; null for copies) and, of copies, ``r_doc``,
    ``r_fold`` and ``r_place``, the row that stands for them; a row that stands for others is a copy of
    itself with ``ask`` false."""
    by_context = Window.partitionBy("gram", "context")
    ordered = by_context.orderBy(F.desc("times"), "doc", "fold", "place")
    n = rows.withColumn("m", F.sum("times").over(by_context)).withColumn("k", F.row_number().over(ordered))
    here, repeated = F.col("times") > 0, F.col("m") > 1
    stands = [F.when(~here, F.col(f"r_{c}")).when(repeated, F.first(c).over(ordered)).alias(f"r_{c}") for c in ("doc", "fold", "place")]
    ask = F.when(here & (F.col("k") == 1), ~repeated)
    return n.select(F.when(ask.isNotNull(), F.col("gram")).alias("gram"), "doc", "fold", "place", ask.alias("ask"), *stands)


def wanted_anchors(anchors: DataFrame) -> DataFrame:
    """Anchors whose contexts are to be compared: gram, doc, fold, place, ``ask`` (false for the copy of a
    repeated context that others are compared with) and ``crowd``. Contexts are counted by gram with
    partial counts, and joined back to a written table, whose skew Spark can split: a gram that is
    everywhere has its rows in many tasks."""
    ones = anchors.where("ask IS NOT NULL").select("gram", "doc", "fold", "place", "ask")
    grams = ones.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.sum(F.col("ask").cast("int")).alias("single"))
    grams = stash(grams.where("kinds > 1 AND single > 0").select("gram", (F.col("kinds") > CROWD).alias("crowd")), "grams")
    wanted = stash(ones.join(hinted(grams, GRAMS_BROADCAST), "gram").select("gram", "doc", "fold", "place", "ask", "crowd"), "wanted")
    discard(grams)
    return wanted


def packed_texts(documents: DataFrame, key: str, text: str) -> DataFrame:
    """doc, fold and the compressed text, which halves what a join by document shuffles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = [pack.compress((t or "").encode("utf-8", "replace")) for t in b["_text"]]
            yield pd.DataFrame({"doc": b["doc"], "fold": b["fold"], "missing": b["missing"], "packed": packed})

    return _keyed(documents, key, text).mapInPandas(run, "doc long, fold int, missing boolean, packed binary")


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _starts(run: np.ndarray) -> np.ndarray:
    """Where a new run begins, given whether each row but the first follows its predecessor."""
    return np.nonzero(np.r_[True, ~run])[0]


def _string_rows(strings: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Of strings of crowded grams, by arrays (hash, hash, start, doc, fold, ask): rows for those that
    differ, each with whether it asks and how often it is there (2 for more), and the copies among
    them as runs (doc, fold, start, count, r_doc, r_fold, r_start), of which no row is needed."""
    one, two, at, doc, fold, ask = (np.concatenate(x) for x in zip(*strings, strict=True))
    order = np.lexsort((two, one))
    first = _starts((one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1]))
    times = np.diff(np.r_[first, len(order)])
    seed = order[first]
    rows = [(one[k], two[k], None, doc[k], fold[k], int(at[k]) << (SPAN_BITS + OFF_BITS) | 1, bool(ask[k]), min(n, 2)) for k, n in zip(seed.tolist(), times.tolist(), strict=True)]
    stands = np.empty(len(order), np.int64)
    stands[order] = np.repeat(seed, times)
    copy = np.nonzero(stands != np.arange(len(stands)))[0]
    copies = []
    if len(copy):
        to = stands[copy]
        follows = (at[copy][1:] == at[copy][:-1] + 1) & (at[to][1:] == at[to][:-1] + 1)
        for x in (doc, fold):
            follows &= (x[copy][1:] == x[copy][:-1]) & (x[to][1:] == x[to][:-1])
        begin = _starts(follows)
        for i, n in zip(begin.tolist(), np.diff(np.r_[begin, len(copy)]).tolist(), strict=True):
            k, r = copy[i], to[i]
            copies.append((doc[k], fold[k], at[k], n, doc[r], fold[r], at[r]))
    return rows, copies


CONTEXTS = (
    "gram long, second long, bytes binary, doc long, fold int, place long, ask boolean, times int,"
    " start long, count long, r_doc long, r_fold int, r_start long"
)
COPY = ["doc", "fold", "start", "count", "r_doc", "r_fold", "r_start"]


def _copied_runs(data: bytes, copies, length: int) -> list[tuple]:
    """(r_doc, r_fold, r_start, bytes) of a document's copies, those that follow each other in both
    documents as one."""
    start, count, doc, fold, to = (np.array([m[x] for m in copies], np.int64) for x in COPY[2:])
    order = np.lexsort((start, to - start, fold, doc))
    start, end, doc, fold, to = start[order], (start + count - 1 + length)[order], doc[order], fold[order], to[order]
    follows = (doc[1:] == doc[:-1]) & (fold[1:] == fold[:-1]) & ((to - start)[1:] == (to - start)[:-1]) & (start[1:] <= end[:-1])
    first = _starts(follows)
    last = np.maximum.reduceat(end, first)
    return [(doc[k], fold[k], to[k], data[start[k] : e]) for k, e in zip(first.tolist(), last.tolist(), strict=True)]


def _other(copies: DataFrame) -> DataFrame:
    """Without rows that stand for themselves."""
    return copies.where("doc <> r_doc OR fold <> r_fold OR start <> r_start")


def context_rows(texts: DataFrame, wanted: DataFrame, copies: DataFrame, length: int, base: int) -> DataFrame:
    """What is to be compared. Of a crowded gram: a row for each string that differs from others in the
    batch, with two hashes, and the copies of those (with ``count``). Of the others: a row for each
    context, with its bytes. Of ``copies``: their runs (``bytes`` with r_doc, r_fold and r_start)."""
    nothing = F.lit(None)
    asked = wanted.groupBy("doc", "fold").agg(F.collect_list(F.struct("gram", "place", "ask", "crowd")).alias("_marks"))
    copied = _other(copies).groupBy("doc", "fold").agg(F.collect_list(F.struct(*COPY[2:])).alias("_copies"))
    kinds = asked.schema["_marks"].dataType, copied.schema["_copies"].dataType
    both = asked.withColumn("_copies", nothing.cast(kinds[1])).unionByName(copied.withColumn("_marks", nothing.cast(kinds[0])))
    names = [x.split()[0] for x in CONTEXTS.split(", ")]

    def frame(rows: list[tuple], strings: list[tuple], runs: list[tuple]) -> pd.DataFrame:
        more, found = _string_rows(strings) if strings else ([], [])
        rows = [(*r, *[None] * 5) for r in rows + more]
        rows += [(None, None, None, d, f, None, None, None, at, n, rd, rf, rat) for d, f, at, n, rd, rf, rat in found]
        rows += [(None, None, part, *[None] * 7, rd, rf, rat) for rd, rf, rat, part in runs]
        columns = dict(zip(names, zip(*rows, strict=True), strict=True))
        for c, kind in zip(names, CONTEXTS.split(", "), strict=True):  # with nulls, and of more bits than a float holds
            if kind.split()[1] in ("long", "int"):
                columns[c] = pd.array(list(columns[c]), dtype="Int64")
        return pd.DataFrame(columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, strings, runs, size = [], [], [], 0
        for b in batches:
            for doc, fold, packed, found, again in zip(b["doc"], b["fold"], b["packed"], b["_marks"], b["_copies"], strict=True):
                data = _unpack(packed)
                hashes = None
                if again is not None:
                    runs += _copied_runs(data, again, length)
                    size += sum(len(r[3]) for r in runs[-len(again) :])
                for m in found if found is not None else ():
                    span = m["place"] & ((1 << SPAN_BITS) - 1)
                    lo = m["place"] >> (SPAN_BITS + OFF_BITS)
                    if not m["crowd"]:
                        part = data[lo : lo + span - 1 + length]
                        out.append((m["gram"], None, part, doc, fold, m["place"], m["ask"], 1))
                        size += len(part)
                        continue
                    if hashes is None:
                        flat = np.frombuffer(data, np.uint8)
                        hashes = (PrefixHashes(flat), PrefixHashes(flat, base))
                    at = np.arange(lo, lo + span)
                    one, two = (_mixed(h.of(at, length)).view(np.int64) for h in hashes)
                    strings.append((one, two, at, np.full(span, doc), np.full(span, fold), np.full(span, m["ask"])))
                    size += 40 * span
                if size > FLAT_BYTES:
                    yield frame(out, strings, runs)
                    out, strings, runs, size = [], [], [], 0
        if size:
            yield frame(out, strings, runs)

    marks = both.groupBy("doc", "fold").agg(F.first("_marks", ignorenulls=True).alias("_marks"), F.first("_copies", ignorenulls=True).alias("_copies"))
    return texts.join(marks, ["doc", "fold"]).mapInPandas(run, CONTEXTS)


class SuffixSort:
    """Merge sort of suffixes within segments, comparing by common extensions."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.hashes = PrefixHashes(data)

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The length of the common prefix of suffixes x and y, at most ``length``, by binary search."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length, np.int64)
        while True:
            active = low < high
            if not active.any():
                return low
            middle = (low + high + 1) // 2
            same = self.hashes.of(x, middle) == self.hashes.of(y, middle)
            low = np.where(active & same, middle, low)
            high = np.where(active & ~same, middle - 1, high)

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x comes before y, or is equal where that is asked."""
        e = self.extension(x, y)
        equal = e == self.length
        step = np.minimum(e, self.length - 1)
        return np.where(equal, or_equal, self.data[x + step] < self.data[y + step])

    def sort(self, suffix: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """The suffixes of each segment in order; ``segment`` is sorted."""
        suffix = suffix.copy()
        first = np.nonzero(np.r_[True, segment[1:] != segment[:-1]])[0]
        counts = np.diff(np.r_[first, len(segment)])
        base, size = np.repeat(first, counts), np.repeat(counts, counts)
        width = 1
        while width < counts.max(initial=1):
            at = np.nonzero(size > width)[0]  # segments that are still in several runs
            local = at - base[at]
            run = local // width
            right = (run % 2).astype(bool)
            other = np.where(right, run - 1, run + 1) * width
            low = np.minimum(other, size[at])
            start, high = low.copy(), np.minimum(other + width, size[at])
            while True:  # how many of the other run come before
                live = np.nonzero(low < high)[0]
                if not len(live):
                    break
                middle = (low[live] + high[live]) // 2
                before = self.less(suffix[base[at[live]] + middle], suffix[at[live]], right[live])
                low[live] = np.where(before, middle + 1, low[live])
                high[live] = np.where(before, high[live], middle)
            merged = base[at] + (run - right) * width + (local - run * width) + (low - start)
            moved = np.empty(len(at), suffix.dtype)
            moved[:] = suffix[at]
            suffix[merged] = moved
            width *= 2
        return suffix

    def agree(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the bytes of suffixes x and y are the same over ``length``."""
        out = np.empty(len(x), bool)
        steps = np.arange(self.length)
        for k in range(0, len(x), 8192):
            part = slice(k, k + 8192)
            out[part] = (self.data[x[part, None] + steps] == self.data[y[part, None] + steps]).all(axis=1)
        return out


def repeated_starts(group: np.ndarray, contexts: list[bytes], off: np.ndarray, span: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Context number and start in it of every string that another context of its group also has at
    the same distance from the anchor."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    base = np.cumsum(sizes) - sizes
    _, number = np.unique(group, return_inverse=True)
    owner = np.repeat(np.arange(len(contexts)), span)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(span) - span, span)
    key = number[owner] * (1 << OFF_BITS) + off[owner] - step
    order = np.argsort(key, kind="stable")
    key = key[order]
    edge = np.r_[True, key[1:] != key[:-1]]
    alone = edge & np.r_[edge[1:], True]
    order, key = order[~alone], key[~alone]
    if not len(order):
        return order, order
    sorter = SuffixSort(np.frombuffer(b"".join(contexts), np.uint8), length)
    suffix = base[owner[order]] + step[order]
    back = np.argsort(suffix, kind="stable")
    ordered = sorter.sort(suffix, key)
    origin = order[back[np.searchsorted(suffix[back], ordered)]]
    x, y = ordered[:-1], ordered[1:]
    same = (key[1:] == key[:-1]) & (sorter.hashes.of(x, length) == sorter.hashes.of(y, length))
    pairs = np.nonzero(same)[0]
    true = sorter.agree(x[pairs], y[pairs])
    if not true.all():  # a collision: compare the strings of its segments as they are
        for k in np.unique(key[pairs[~true]]):
            inside = np.nonzero(key == k)[0]
            strings = [sorter.data[s : s + length].tobytes() for s in ordered[inside]]
            rank = sorted(range(len(strings)), key=strings.__getitem__)
            ordered[inside], origin[inside] = ordered[inside][rank], origin[inside][rank]
            exact = [strings[p] == strings[q] for p, q in zip(rank, rank[1:], strict=False)]
            same[inside[:-1]] = exact
    hit = np.zeros(len(ordered), bool)
    hit[:-1] |= same
    hit[1:] |= same
    chosen = np.unique(origin[hit])
    return owner[chosen], step[chosen]


def compared(contexts: DataFrame, length: int) -> DataFrame:
    """doc, fold, start and count of the runs of repeated starts that the suffix sort finds."""

    def results(rows: list[tuple]) -> pd.DataFrame:
        place = np.array([r[4] for r in rows], np.int64)
        span = place & ((1 << SPAN_BITS) - 1)
        off = (place >> SPAN_BITS) & ((1 << OFF_BITS) - 1)
        owner, step = repeated_starts(np.array([r[0] for r in rows]), [r[1] for r in rows], off, span, length)
        start = (place >> (SPAN_BITS + OFF_BITS))[owner] + step
        new = np.r_[True, (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)] if len(owner) else np.empty(0, bool)
        first = np.nonzero(new)[0]
        count = np.diff(np.r_[first, len(owner)])
        docs, folds = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        return pd.DataFrame({"doc": docs[owner[first]], "fold": folds[owner[first]], "start": start[first], "count": count})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        held, last = 0, None
        for b in batches:
            for r in zip(b["gram"], b["bytes"], b["doc"], b["fold"], b["place"], strict=True):
                if r[0] != last and held > FLAT_BYTES:
                    yield results(rows)
                    rows, held = [], 0
                last = r[0]
                rows.append(r)
                held += len(r[1])
        if rows:
            yield results(rows)

    grouped = contexts.where("bytes IS NOT NULL AND r_doc IS NULL").select("gram", "bytes", "doc", "fold", "place")
    grouped = grouped.repartition("gram").sortWithinPartitions("gram")
    return grouped.mapInPandas(run, "doc long, fold int, start long, count long")


def split_copies(contexts: DataFrame) -> DataFrame:
    """The same for crowded grams, as copies (runs of ``count`` starts and the ones that stand for them):
    strings whose 128 bits of hash are found twice or more, and those known already. Counts are
    combined before their shuffle."""
    strings = contexts.where("second IS NOT NULL")
    first = F.min(F.struct("doc", "fold", "place"))
    twice = strings.groupBy("gram", "second").agg(F.sum("times").alias("n"), first.alias("first")).where("n > 1")
    twice = stash(twice.select("gram", "second", "first"), "repeated-strings")
    low = lambda c: F.shiftright(c, SPAN_BITS + OFF_BITS)
    found = strings.join(twice, ["gram", "second"]).select(
        "doc", "fold", low("place").alias("start"), F.lit(1).cast("long").alias("count"), F.col("first.doc").alias("r_doc"),
        F.col("first.fold").alias("r_fold"), low("first.place").alias("r_start"),
    )
    return found.union(contexts.where("count IS NOT NULL").select(*COPY))


def context_copies(anchors: DataFrame) -> DataFrame:
    """Copies of whole contexts."""
    start, count = F.shiftright("place", SPAN_BITS + OFF_BITS), F.col("place").bitwiseAND(F.lit((1 << SPAN_BITS) - 1))
    r_start = F.shiftright("r_place", SPAN_BITS + OFF_BITS)
    again = anchors.where("r_place IS NOT NULL")
    return again.select("doc", "fold", start.alias("start"), count.alias("count"), "r_doc", "r_fold", r_start.alias("r_start"))


def string_runs(texts: DataFrame, copies: DataFrame, length: int) -> DataFrame:
    """The runs of copies of crowded grams' strings: r_doc, r_fold, r_start and bytes."""
    marks = _other(copies).groupBy("doc", "fold").agg(F.collect_list(F.struct(*COPY[2:])).alias("_copies"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for packed, found in zip(b["packed"], b["_copies"], strict=True):
                yield pd.DataFrame(_copied_runs(_unpack(packed), found, length), columns=["r_doc", "r_fold", "r_start", "bytes"])

    return texts.join(marks, ["doc", "fold"]).mapInPandas(cut, "r_doc long, r_fold int, r_start long, bytes binary")


def differing(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """One column ``bad``: for each batch, how many of the written ``runs`` of copies (r_doc, r_fold, r_start,
    bytes) differ in a byte from what stands for them. Each repeated byte is sent about once, to the
    document that has the other one; only such documents are read."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, data = None, b""
        for b in batches:
            bad = 0
            for doc, fold, packed, at, part in zip(b["r_doc"], b["r_fold"], b["packed"], b["r_start"], b["bytes"], strict=True):
                if (doc, fold) != last:
                    last, data = (doc, fold), _unpack(packed)
                bad += data[at : at + len(part)] != part
            yield pd.DataFrame({"bad": [bad]})

    others = stash(runs.select(F.col("r_doc").alias("doc"), F.col("r_fold").alias("fold")).distinct(), "copied-documents")
    there = texts.join(hinted(others), ["doc", "fold"], "left_semi").select(F.col("doc").alias("r_doc"), F.col("fold").alias("r_fold"), "packed")
    met = runs.join(there, ["r_doc", "r_fold"]).select("r_doc", "r_fold", "packed", "r_start", "bytes")
    return met.mapInPandas(compare, "bad long")


def repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """doc, fold and ``_runs`` (array of struct(start, count)), the starts, in bytes, of the strings of
    ``length`` bytes that also start anywhere else; and the packed texts. The base of one of the two
    hashes changes if a copy is found to differ."""
    if not GRAM < length <= GRAM + (1 << OFF_BITS) - 1:
        raise ValueError(f"length must be over {GRAM} and at most {GRAM + (1 << OFF_BITS) - 1}")
    texts = stash(packed_texts(documents, key, text), "packed-texts")
    for base in (BASE2, *SPARE_BASES):
        anchors = stash(known_anchors(anchor_rows(documents, key, text, length, base)), "anchors")
        wanted = wanted_anchors(anchors)
        copies = stash(context_copies(anchors), "context-copies")
        discard(anchors)
        contexts = stash(context_rows(texts, wanted, copies, length, base), "contexts")
        discard(wanted)
        more = stash(split_copies(contexts), "string-copies")
        runs = contexts.where("bytes IS NOT NULL AND r_doc IS NOT NULL").select("r_doc", "r_fold", "r_start", "bytes")
        if not more.isEmpty():
            runs = runs.union(stash(string_runs(texts, more, length), "string-runs"))
        if not differing(texts, runs).agg(F.sum("bad")).first()[0]:
            break
    else:
        raise ArithmeticError("different strings agree in all hashes")
    found = stash(compared(contexts, length), "compared")
    discard(contexts)
    copies = copies.union(more)
    found = found.union(copies.select("doc", "fold", "start", "count")).union(copies.select("r_doc", "r_fold", "r_start", "count"))
    return found.groupBy("doc", "fold").agg(F.collect_set(F.struct("start", "count")).alias("_runs")), texts


def removed_runs(size: int, runs, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the maximal runs of bytes that the repeated strings cover."""
    if runs is None or not len(runs):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begin = np.array([r["start"] for r in runs], np.int64)
    end = begin + np.array([r["count"] for r in runs], np.int64) - 1 + length
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > reach[:-1]]
    return begin[new], np.minimum(reach[np.r_[np.nonzero(new)[0][1:] - 1, len(reach) - 1]], size)


def _kept(data: bytes, begin: np.ndarray, end: np.ndarray) -> bytes:
    edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(data)]
    return b"".join(data[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def digests(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of the bytes
    that remain. A null text is empty; texts shorter than ``length`` lose nothing; rows that repeat
    a document repeat all its strings; rows that share an id but not a text are told apart."""
    runs, texts = repeats(documents, key, text, length)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for packed, found in zip(b["packed"], b["_runs"], strict=True):
                data = _unpack(packed)
                begin, end = removed_runs(len(data), found, length)
                kept = _kept(data, begin, end)
                out.append((len(data), int((end - begin).sum()), len(begin), hashlib.sha256(kept).hexdigest()))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pd.concat([b[["doc", "missing"]].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    joined = texts.join(runs, ["doc", "fold"], "left").select("doc", "missing", "packed", "_runs")
    cut = joined.mapInPandas(run, "doc long, missing boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return cut.select(F.when(~F.col("missing"), F.col("doc")).alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def cut_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``documents`` with each text cut; all other columns stay. What a cut leaves of a character
    is dropped with it. A null text stays null."""
    runs = repeats(documents, key, text, length)[0].withColumnsRenamed({"doc": "_doc", "fold": "_fold"})

    @F.pandas_udf("string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, found in batches:
            out = []
            for t, f in zip(texts, found, strict=True):
                if t is None or f is None or not len(f):
                    out.append(t)
                    continue
                data = t.encode("utf-8", "replace")
                out.append(_kept(data, *removed_runs(len(data), f, length)).decode("utf-8", "ignore"))
            yield pd.Series(out, dtype=object)

    rows = documents.select(F.struct("*").alias("_row"))  # so that no column's name can clash
    id_, text_ = F.col("_row")[key], F.col("_row")[text]
    here = (F.coalesce(id_.cast("long"), F.lit(0)) == F.col("_doc")) & (F.hash(id_.isNull(), text_) == F.col("_fold"))
    joined = rows.join(runs, here, "left").withColumn("_cut", cut(text_, F.col("_runs")))
    return joined.select(*[(F.col("_cut") if c == text else F.col("_row")[c]).alias(c) for c in documents.columns])


DEDUP_SQL = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (
  SELECT k, i, md5(substr(h, 2 * i + 1, {2 * LENGTH})) AS m
  FROM (SELECT k, h, unnest(range(0, len(h) // 2 - {LENGTH} + 1)) AS i FROM d WHERE len(h) >= {2 * LENGTH})),
r AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY m) AS c FROM s) WHERE c > 1),
marked AS (SELECT k, i, CASE WHEN i > lag(i) OVER (PARTITION BY k ORDER BY i) + {LENGTH} THEN 1 ELSE 0 END AS new FROM r),
islands AS (
  SELECT k, min(i) AS b, max(i) + {LENGTH} AS e
  FROM (SELECT k, i, sum(new) OVER (PARTITION BY k ORDER BY i) AS g FROM marked) GROUP BY k, g),
pieces AS (
  SELECT k, coalesce(lag(e) OVER w, 0) AS f, b AS t FROM islands WINDOW w AS (PARTITION BY k ORDER BY b)
  UNION ALL SELECT k, max(e), NULL FROM islands GROUP BY k
  UNION ALL SELECT k, 0, NULL FROM d WHERE k NOT IN (SELECT k FROM islands)),
kept AS (
  SELECT k, string_agg(substr(h, 2 * f + 1, 2 * (coalesce(t, len(h) // 2) - f)), '' ORDER BY f) AS h FROM pieces JOIN d USING (k) GROUP BY k),
sums AS (SELECT k, CAST(sum(e - b) AS BIGINT) AS n, count(*) AS c FROM islands GROUP BY k)
SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(c, 0) AS n_spans,
       sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (k) LEFT JOIN sums USING (k)
"""
