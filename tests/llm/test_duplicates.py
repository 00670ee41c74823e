"""Near duplicates, repeated strings and benchmark passages, against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tidelog.llm import decontaminate, ngram_join, suffix_dedup
from tidelog.llm.components import components

from .conftest import PROSE, TEXTS

DOCS = "doc_id long, text string"


def brute_components(rows, size=4, percent=85):
    sets = {}
    for d, t in rows:
        if d is not None:
            sets[d] = max(sets.get(d, set()), ngram_join.shingle_set(t, size), key=len)
    least = {d: d for d in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def family_rows(seed, edits):
    """Families of copies with few and many edits, near the similarity asked for."""
    r = random.Random(seed)
    rows, k = [], 0
    for _ in range(6):
        base = [f"w{r.randrange(60)}" for _ in range(r.choice([5, 30, 60, 90]))]
        for _ in range(14):
            words = list(base)
            for _ in range(r.randrange(edits)):
                at = r.randrange(len(words))
                kind = r.randrange(3)
                if kind == 0:
                    words[at] = f"n{r.randrange(1000)}"
                elif kind == 1:
                    words.insert(at, "extra")
                elif len(words) > 1:
                    del words[at]
            rows.append((k, " ".join(words)))
            k += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "edits"), [(1, 3), (2, 6), (3, 9)])
def test_near_duplicates_by_brute_force(spark, seed, edits):
    rows = family_rows(seed, edits)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute_components(rows)


def test_the_sample_leaves_a_bound_at_every_similarity():
    for percent in range(1, 100):
        share = ngram_join.sampled_share(percent)
        assert share == 100 or share > 100 - percent
    assert ngram_join.sampled_share(85) == 20 and ngram_join.sampled_share(80) == 27


@pytest.mark.parametrize(("seed", "edits"), [(1, 6)])
def test_groups_open_by_their_bound(spark, monkeypatch, seed, edits):
    """Which groups the token-group matrix opens, against sets; and that links need opened groups."""
    rows = family_rows(seed, edits)
    seen, real = [], ngram_join.open_groups

    def opened(docs, asks, members, percent):
        got = real(docs, asks, members, percent)
        sets = {r.doc: (r.n, set(r.tokens)) for r in docs.collect()}
        union = {}
        for r in members.collect():
            union.setdefault(r["group"], set()).update(sets[r.doc][1])
        expected = {(r.doc, r.other) for r in asks.collect() if len(sets[r.doc][1] & union[r.other]) >= -(-percent * sets[r.doc][0] // 100)}
        assert {(r.doc, r.other) for r in got.collect()} == expected
        seen.append((asks.count(), len(expected)))
        return got

    monkeypatch.setattr(ngram_join, "open_groups", opened)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == brute_components(rows)
    assert len(seen) == 2 and seen[0][1] > 0  # leaders, then members
    monkeypatch.setattr(ngram_join, "open_groups", lambda docs, asks, members, percent: asks.limit(0))
    closed = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join_documents(spark.createDataFrame(rows, DOCS)).collect()}
    assert closed != got


def test_rows_that_share_an_id_are_told_apart_by_their_texts(spark):
    other = " ".join(f"z{i}" for i in range(40))
    rows = [(1, PROSE), (1, other), (1, other), (2, PROSE + " again"), (3, other + " z"), (None, PROSE), (4, None), (4, None)]
    kept = [tuple(r) for r in ngram_join.one_of_each(spark.createDataFrame(rows, DOCS), size=5, percent=80).collect()]
    assert sorted(kept, key=str) == sorted([(2, PROSE + " again"), (3, other + " z"), (None, PROSE), (4, None)], key=str)


def test_every_size_has_a_prefix_that_meets_its_partners():
    """Two sets with the least overlap that links them have slack for all that is not shared."""
    for n in range(1, 300):
        for m in range(n, n * 100 // 85 + 1):
            need = -(-85 * (n + m) // 185)
            if need <= n:
                assert m - need <= m - (m * 85 + 99) // 100
                left = need  # tokens that remain from the first shared one on
                assert m <= left * 185 // 85 - n and n <= left * 185 // 85 - m


def test_near_duplicates_of_odd_tables(odd_documents, no_documents):
    rows = ngram_join.join_documents(odd_documents).collect()
    expected = brute_components(TEXTS)
    assert len(rows) == len(TEXTS)
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
    nameless = [(len(ngram_join.shingle_set(t, 4)), None) for d, t in TEXTS if d is None]
    assert sorted((r.n_shingles, r.component_id) for r in rows if r.doc_id is None) == sorted(nameless)
    assert expected[3][1] == 1
    kept = ngram_join.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, None, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, None]))
    assert ngram_join.join_documents(no_documents).count() == 0 and ngram_join.one_of_each(no_documents).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 90)]
    random.Random(1).shuffle(chain)
    links = spark.createDataFrame(chain + [(200, 300), (300, 250), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(91)} | {200: 200, 250: 200, 300: 200}
    assert components(links.limit(0)).count() == 0


def brute_cut(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for i, b in enumerate(data):
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p : p + length], []).append((i, p))
    covered = [np.zeros(len(b), bool) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                covered[i][p : p + length] = True
    out = []
    for b, c in zip(data, covered, strict=True):
        kept = bytes(x for x, gone in zip(b, c, strict=True) if not gone)
        spans = int((c & ~np.r_[False, c[:-1]]).sum()) if len(c) else 0
        out.append((len(b), int(c.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed, length):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcé") for _ in range(r.randrange(1, 6)))
    common = [" ".join(word() for _ in range(length // 3 + k)) for k in (-9, 0, 15, 60)]
    texts = []
    for _ in range(40):
        parts = [" ".join(word() for _ in range(r.randrange(40))) for _ in range(3)]
        parts.insert(r.randrange(4), r.choice(common))
        if r.random() < 0.3:
            parts.append(r.choice(common)[r.randrange(20) :])
        texts.append(" ".join(parts))
    return [*texts, texts[0], "ab" * 300, "xab" + "ab" * 150, "", None, "\n".join(["the same line over and over"] * 40)]


@pytest.mark.parametrize(("seed", "length", "crowd", "flat"), [(1, 200, 2000, 1 << 20), (2, 100, 1, 500), (3, 60, 3, 1 << 20), (4, 41, 2, 2000)])
def test_repeated_strings_by_brute_force(spark, monkeypatch, seed, length, crowd, flat):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "FLAT_BYTES", flat)
    texts = passages(seed, length)
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(docs, length=length).collect()}
    assert got == dict(enumerate(brute_cut(texts, length)))


def test_suffixes_are_sorted_and_collisions_verified(monkeypatch):
    r = random.Random(5)
    contexts = [bytes(r.choice(b"ab") for _ in range(60)) for _ in range(30)]
    contexts += contexts[:5]
    sorter = suffix_dedup.SuffixSort(np.frombuffer(b"".join(contexts), np.uint8), 12)
    suffix = np.array([60 * i + j for i in range(35) for j in range(40)])
    segment = np.repeat(np.arange(7), 200)
    order = sorter.sort(suffix, segment)
    data = b"".join(contexts)
    for k in range(7):
        part = [data[s : s + 12] for s in order[segment == k]]
        assert part == sorted(part) and sorted(order[segment == k]) == sorted(suffix[segment == k])
    group = np.zeros(35, np.int64)
    args = (group, contexts, np.full(35, 20), np.full(35, 15), 12)
    expected = [x.tolist() for x in suffix_dedup.repeated_starts(*args)]
    true_of = suffix_dedup.PrefixHashes.of
    monkeypatch.setattr(suffix_dedup.PrefixHashes, "of", lambda self, s, size: true_of(self, s, size) * (np.asarray(size) != 12).astype(np.uint64))
    assert [x.tolist() for x in suffix_dedup.repeated_starts(*args)] == expected


@pytest.mark.parametrize("crowd", [2000, 1])
def test_copies_are_verified_by_their_bytes(spark, monkeypatch, crowd):
    """With a base of 1 a hash is a sum of bytes, so contexts of the same bytes in another order agree;
    the copies are found to differ and the next base is taken."""
    monkeypatch.setattr(suffix_dedup, "BASE2", 1)
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    r = random.Random(3)
    body = [r.choice("abcdefgh") for _ in range(900)]
    texts = []
    for k in range(30):
        changed = list(body)
        for at in range(k % 3 * 20, 900, 230):
            changed[at], changed[at + 1 + k % 5] = changed[at + 1 + k % 5], changed[at]
        texts.append("".join(changed))
    calls, real = [], suffix_dedup.differing

    def differing(texts, runs):
        out = real(texts, runs)
        calls.append(out.agg({"bad": "sum"}).first()[0] or 0)
        return out

    monkeypatch.setattr(suffix_dedup, "differing", differing)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert got == dict(enumerate(brute_cut(texts, 200)))
    assert len(calls) == 2 and calls[0] > 0 == calls[1]
    monkeypatch.setattr(suffix_dedup, "SPARE_BASES", ())
    with pytest.raises(ArithmeticError):
        suffix_dedup.digests(spark.createDataFrame(list(enumerate(texts)), DOCS))


def test_a_gram_that_is_everywhere_is_spread(spark, monkeypatch):
    """One line in many contexts: no window or group by gram alone holds its rows, and the strings of its
    contexts are dealt by their hashes."""
    monkeypatch.setattr(suffix_dedup, "CROWD", 20)
    r = random.Random(8)
    line = "".join(r.choice("abcdefghijklmnop ") for _ in range(150))
    texts = ["".join(r.choice("abcdefghijklmnop ") for _ in range(170)) + line + "".join(r.choice("abcdefghijklmnop ") for _ in range(170)) for _ in range(600)]
    texts += [texts[5][:120] + texts[9][120:], texts[7][90:330] + "zz"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digests(docs).collect()}
    assert got == dict(enumerate(brute_cut(texts, 200)))
    anchors = suffix_dedup.known_anchors(suffix_dedup.anchor_rows(docs, "doc_id", "text", 200, suffix_dedup.BASE2))
    wanted = suffix_dedup.wanted_anchors(anchors)
    hot = wanted.where("crowd").groupBy("gram").count().orderBy("count", ascending=False).first()
    assert hot["count"] >= 200
    texts_ = suffix_dedup.packed_texts(docs, "doc_id", "text")
    rows = suffix_dedup.context_rows(texts_, wanted, suffix_dedup.context_copies(anchors), 200, suffix_dedup.BASE2)
    assert rows.where("second IS NOT NULL").groupBy("gram", "second").count().agg({"count": "max"}).first()[0] <= 4
    assert rows.where("bytes IS NOT NULL AND gram IS NOT NULL").groupBy("gram").count().agg({"count": "max"}).first()[0] <= 20
    plan = anchors._jdf.queryExecution().executedPlan().toString()
    assert all("context#" in x.split(")")[0] for x in plan.split("hashpartitioning(")[1:])


def test_repeated_strings_of_odd_tables(odd_documents, no_documents):
    expected = sorted(str((d, *b)) for (d, _), b in zip(TEXTS, brute_cut([t for _, t in TEXTS], 200), strict=True))
    assert sorted(str(tuple(r)) for r in suffix_dedup.digests(odd_documents).collect()) == expected
    cut = suffix_dedup.cut_documents(odd_documents)
    assert cut.columns == odd_documents.columns and cut.count() == len(TEXTS)
    texts = {(r.doc_id, r.text) for r in cut.collect()}
    assert (8, "") in texts and (4, None) in texts and (11, "x") in texts
    assert suffix_dedup.digests(no_documents).count() == suffix_dedup.cut_documents(no_documents).count() == 0


BENCH = "item_id long, text string, n long"


def brute_contamination(text, items):
    def words(t):
        out, word = [], ""
        for c in (t or "") + "\0":
            c = c.lower() if "A" <= c <= "Z" else c
            if c.isdigit() and c.isascii() or "a" <= c <= "z" or ord(c) >= 0x80:
                word += c
            elif word:
                out.append(word)
                word = ""
        return out

    have, hit, found = words(text), set(), set()
    for i, t in items:
        w = words(t)
        size = min(13, len(w))
        grams = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
        for p in range(len(have) - size + 1):
            if size and tuple(have[p : p + size]) in grams:
                hit |= set(range(p, p + size))
                found.add(str(i))
    names = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(have), len(hit), len(found), names, bool(hit) and 20 * len(hit) >= len(have)


def test_contamination_by_brute_force(spark, odd_documents, no_documents):
    r = random.Random(2)
    vocabulary = [f"{c}{k}é" for c in "ab" for k in range(9)] + ["Ünit"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 5, 13, 14, 30])))) for i in range(25)]
    items += [(30, ""), (31, None), (32, "!!"), (None, "lost item words here"), (2, items[2][1]), (33, items[0][1])]
    texts = []
    for i in range(60):
        parts = [r.choice(vocabulary) for _ in range(r.randrange(80))]
        for _ in range(r.randrange(3)):
            w = (r.choice(items)[1] or "").split()
            at = r.randrange(len(parts) + 1)
            parts[at:at] = w[: r.randrange(len(w) + 1)] if r.random() < 0.5 else w
        texts.append((i, r.choice([" ", "\n", "--"]).join(parts).upper() if i % 7 == 0 else " ".join(parts)))
    bench = spark.createDataFrame([(*x, 1) for x in items], BENCH)
    docs = spark.createDataFrame(texts, DOCS).repartition(3)
    named = [(i, t) for i, t in items if i is not None]
    got = {r.doc_id: tuple(r)[1:6] for r in decontaminate.contamination(docs, bench.where("item_id IS NOT NULL")).collect()}
    assert got == {d: brute_contamination(t, named) for d, t in texts}
    assert any(x[4] for x in got.values()) and not all(x[4] for x in got.values())
    assert decontaminate.contamination(docs, bench).count() == len(texts)
    odd = decontaminate.contamination(odd_documents, bench.where("item_id IS NOT NULL")).collect()
    assert sorted(str(tuple(r)[:6]) for r in odd) == sorted(str((d, *brute_contamination(t, named))) for d, t in TEXTS)
    assert decontaminate.contamination(no_documents, bench).count() == 0
    clean = decontaminate.clean_documents(odd_documents, bench.limit(0))
    assert clean.columns == odd_documents.columns and clean.count() == len(TEXTS)


def brute_near(text, items, docs, slop=8):
    """Distinct ids of the items whose two rarest words stand close to each other."""
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    counts = collections.Counter(w for t in docs for w in words(t))
    here, found = words(text), set()
    for i, t in items:
        rare = sorted({w for w in words(t) if counts[w]}, key=lambda w: (counts[w], w))[:2]
        if len(rare) == 2:
            one, two = ([k for k, w in enumerate(here) if w == r] for r in rare)
            if any(abs(a - b) <= slop for a in one for b in two):
                found.add(i)
    return len(found)


def test_near_items_by_brute_force(spark):
    r = random.Random(5)
    draw = lambda n: " ".join(f"w{int(r.paretovariate(0.6)) % 300}" for _ in range(n))
    texts = [(i, draw(r.randrange(120))) for i in range(60)]
    items = [(i % 25, draw(r.randrange(1, 30))) for i in range(30)] + [(None, draw(9)), (None, draw(9))]
    bench = spark.createDataFrame([(*x, 0) for x in items], BENCH)
    got = {r.doc_id: r.n_near for r in decontaminate.contamination(spark.createDataFrame(texts, DOCS), bench).collect()}
    assert got == {d: brute_near(t, items, [t for _, t in texts]) for d, t in texts}
    assert max(got.values()) > 1


def test_items_without_an_id_count_but_are_not_named(spark):
    docs = spark.createDataFrame([(1, PROSE), (2, "nothing of it")], DOCS)
    bench = spark.createDataFrame([(None, PROSE, 0), (None, PROSE + " more", 0), (7, PROSE, 0)], BENCH)
    got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
    assert got[1].n_items == 2 and got[1].items_sha256 == hashlib.sha256(b"7").hexdigest() and got[1].contaminated
    assert got[2].n_items == 0 and got[2].n_hit == 0


def test_long_items_take_linear_tables(spark):
    """An item of 20,000 words, one of as many equal words, and one that repeats a passage."""
    long = [f"t{i}" for i in range(20_000)]
    same, again = ["la"] * 20_000, [f"p{i % 40}" for i in range(4000)]
    bench = spark.createDataFrame([(1, " ".join(long), 0), (2, " ".join(same), 0), (3, " ".join(again), 0)], BENCH)
    items = decontaminate.item_words(bench)
    terms, placed = decontaminate.item_terms(items)
    docs = [(1, " ".join(long[500:9000])), (2, " ".join(same[:3000])), (3, " ".join(again[7:200])), (4, "la " * 12), (5, " ".join(long[::2]))]
    documents = spark.createDataFrame(docs, DOCS)
    wins = decontaminate.windows(placed, decontaminate.term_counts(decontaminate.build_index(documents, terms)))
    assert wins.count() <= 44_000 and placed.count() == 44_000
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(documents, bench).collect()}
    assert got == {1: (8500, 8500, 1), 2: (3000, 3000, 1), 3: (193, 193, 1), 4: (12, 0, 0), 5: (10_000, 0, 0)}


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "rare1 the the rare2", 0)], BENCH)
    texts = [(1, "rare2 x x rare1 the the the"), (2, "rare1 " + "the " * 20 + "rare2"), (3, "the rare1"), (4, "rare1 rare2 the")]
    got = {r.doc_id: r.gap for r in decontaminate.proximity(spark.createDataFrame(texts, DOCS), bench, slop=5).collect()}
    assert got == {1: 3, 4: 1}
