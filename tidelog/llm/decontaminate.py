"""Benchmark decontamination with a distributed positional inverted index.

1. The index: a posting (term, document, position) for every occurrence of a word that the
   benchmark uses, written in the order of the documents, so that it is built without a shuffle. A
   search reads a few narrow columns of it; the texts are tokenised once.
2. Terms are counted in the index. Of each distinct window of an item the two rarest words are its
   anchors.
3. Postings of anchors are adjusted by the word's place in the item: those of one document and item
   that agree lie on one alignment. Intersecting the lists keeps the alignments with both anchors
   of some window.
4. The lists of the other words, adjusted alike, are intersected on these alignments alone: the
   places of the item that the document matches. Where a window's places all match, it occurs.
5. Counts of hit words and names of items are joined with the documents' keys; texts never move.

Proximity matches come from the same index: the two rarest words of an item close to each other.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import ascii_lower, hinted, stash

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: A document is contaminated if at least one word in so many is in an occurring window.
ONE_IN = 20
NEAR = 8  # words between the two rarest words of an item for a proximity match
DOC = ["_id", "_hash"]
ALIGNMENT = [*DOC, "item_no", "shift"]


def plain_words(text: Column) -> Column:
    """Words of digits, a-z (A-Z lower-cased) and characters beyond ASCII; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), ANY_CASE_BREAK), "")).cast("long")


def document_keys(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What tells documents apart, rows with an equal or no id by their texts: ``_id`` and ``_hash``,
    with ``_text``."""
    return documents.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))


def same_document(other_id: str, other_hash: str) -> Column:
    return F.col("_id").eqNullSafe(F.col(other_id)) & (F.col("_hash") == F.col(other_hash))


def item_words(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """item_no, item (its id), size and words of each distinct item that has words."""
    rows = benchmark.select(F.col(item).alias("item"), plain_words(F.col(text)).alias("words")).where(F.size("words") > 0)
    numbered = rows.distinct().select(F.monotonically_increasing_id().alias("item_no"), "item", F.size("words").alias("size"), "words")
    return stash(numbered, "benchmark-items")


def item_terms(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (term_no, term) and the items by place (item_no, size, at, term_no)."""
    spread = items.select("item_no", "size", F.posexplode("words").alias("at", "term"))
    terms = stash(spread.select("term").distinct().select(F.monotonically_increasing_id().alias("term_no"), "term"), "benchmark-terms")
    return terms, stash(spread.join(terms, "term").select("item_no", "size", "at", "term_no"), "item-terms")


def build_index(documents: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index: ``_id``, ``_hash``, pos and term_no of each occurrence of a term."""
    words = document_keys(documents, key, text).select(*DOC, F.posexplode(plain_words(F.col("_text"))).alias("pos", "term"))
    return stash(words.join(hinted(terms), "term").select(*DOC, "pos", "term_no"), "postings")


def term_counts(index: DataFrame) -> DataFrame:
    """How often the corpus has each term (term_no, n)."""
    return stash(index.groupBy("term_no").agg(F.count(F.lit(1)).alias("n")), "term-counts")


def windows(placed: DataFrame, counts: DataFrame, size: int = WINDOW) -> DataFrame:
    """Windows whose words all occur in the corpus: item_no, start, length, ``anchors`` (the places of
    its two rarest words in the item, rarest first; one for a window of one word), and ``gram_item``
    and ``gram_start``, the first window of the same words. Each place has its own frame of the
    item's words, so the work is linear in an item's length."""
    ahead = Window.partitionBy("item_no").orderBy("at").rangeBetween(0, size - 1)
    known = placed.join(counts, "term_no")
    framed = known.select(
        "item_no", F.col("at").alias("start"), F.least(F.lit(size), "size").alias("length"), F.collect_list(F.struct("n", "at", "term_no")).over(ahead).alias("inside")
    ).where(F.size("inside") == F.col("length"))
    first = F.min(F.struct("item_no", "start")).over(Window.partitionBy(F.transform("inside", lambda x: x["term_no"])))
    anchors = F.transform(F.slice(F.array_sort("inside"), 1, 2), lambda x: x["at"])
    wins = framed.withColumn("first", first).select(
        "item_no", "start", "length", anchors.alias("anchors"), F.col("first.item_no").alias("gram_item"), F.col("first.start").alias("gram_start")
    )
    return stash(wins, "benchmark-windows")


def rarest_pairs(placed: DataFrame, counts: DataFrame, terms: DataFrame) -> DataFrame:
    """item_no, term_no and ``which`` (0 or 1) of the two rarest different words of each item that
    occur in the corpus; ties by the word. Items with fewer have none."""
    known = placed.select("item_no", "term_no").distinct().join(counts, "term_no").join(terms, "term_no")
    ranked = known.withColumn("which", F.row_number().over(Window.partitionBy("item_no").orderBy("n", "term")) - 1).where("which < 2")
    both = ranked.withColumn("have", F.count(F.lit(1)).over(Window.partitionBy("item_no"))).where("have = 2")
    return stash(both.select("item_no", "term_no", "which"), "rarest-pairs")


def alignments(postings: DataFrame, placed: DataFrame, wins: DataFrame) -> DataFrame:
    """``_id``, ``_hash``, item_no, shift (place in the document minus place in the item) and ``needed``
    (places in the item) of the windows both of whose anchors lie on the alignment. One window
    stands for all of the same words."""
    chosen = wins.where((F.col("item_no") == F.col("gram_item")) & (F.col("start") == F.col("gram_start")))
    pairs = chosen.select(
        F.col("item_no").alias("_item"), "start", "length", F.get("anchors", F.lit(0)).alias("one"), F.get("anchors", F.lit(1)).alias("two")
    )
    pairs = stash(pairs, "anchor-pairs")
    marks = pairs.select(F.col("_item").alias("item_no"), F.explode(F.array_compact(F.array("one", "two"))).alias("at")).distinct()
    marks = stash(marks.join(placed, ["item_no", "at"]).select("item_no", "at", "term_no"), "anchor-places")
    met = postings.join(hinted(marks), "term_no").select(*DOC, "item_no", (F.col("pos") - F.col("at")).alias("shift"), "at")
    lists = met.groupBy(*ALIGNMENT).agg(F.collect_set("at").alias("ats"))
    ones = lists.select(*ALIGNMENT, "ats", F.explode("ats").alias("at"))
    both = F.col("two").isNull() | F.array_contains("ats", F.col("two"))
    found = ones.join(hinted(pairs), (F.col("item_no") == F.col("_item")) & (F.col("at") == F.col("one"))).where(both & (F.col("start") + F.col("shift") >= 0))
    places = F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)
    needed = found.groupBy(*ALIGNMENT).agg(F.array_distinct(F.flatten(F.collect_list(places))).alias("needed"))
    return stash(needed, "alignments")


def occurrences(index: DataFrame, aligned: DataFrame, placed: DataFrame, size: int = WINDOW) -> DataFrame:
    """Exact phrase matches: ``_id``, ``_hash``, item_no, start (in the item), pos and length of each
    window all of whose words stand in the document at its place. The postings of the alignments'
    documents are looked up at the places needed, and neighbouring matches counted."""
    docs = stash(aligned.select(F.col("_id").alias("_id2"), F.col("_hash").alias("_hash2")).distinct(), "aligned-documents")
    there = index.join(hinted(docs), same_document("_id2", "_hash2"), "left_semi")
    there = there.select(F.col("_id").alias("_id2"), F.col("_hash").alias("_hash2"), "pos", F.col("term_no").alias("_term"))
    asked = aligned.select(*ALIGNMENT, F.explode("needed").alias("at")).join(hinted(placed), ["item_no", "at"])
    place = same_document("_id2", "_hash2") & (F.col("at") + F.col("shift") == F.col("pos")) & (F.col("term_no") == F.col("_term"))
    matched = asked.join(there, place).select(*ALIGNMENT, "size", "at").distinct()  # documents may be repeated
    ahead = Window.partitionBy(*ALIGNMENT).orderBy("at").rangeBetween(0, size - 1)
    counted = matched.withColumn("length", F.least(F.lit(size), "size")).withColumn("n", F.count(F.lit(1)).over(ahead))
    whole = counted.where(F.col("n") == F.col("length"))
    return stash(whole.select(*DOC, "item_no", F.col("at").alias("start"), (F.col("at") + F.col("shift")).alias("pos"), "length"), "occurrences")


def hit_words(found: DataFrame) -> DataFrame:
    """``_id``, ``_hash`` and n_hit: the words that occurring windows cover."""
    spans = found.groupBy(*DOC, "pos").agg(F.max(F.col("pos") + F.col("length")).alias("end"))
    before = F.max("end").over(Window.partitionBy(*DOC).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    new = F.col("end") - F.greatest("pos", F.coalesce(before, F.lit(0)))
    return spans.withColumn("new", F.greatest(new, F.lit(0))).groupBy(*DOC).agg(F.sum("new").cast("long").alias("n_hit"))


def hit_items(found: DataFrame, wins: DataFrame, items: DataFrame) -> DataFrame:
    """``_id``, ``_hash`` and ``_items``: the ids, as sorted strings with a null last, of all items
    that have an occurring window."""
    gram = found.select(*DOC, "item_no", "start").join(hinted(wins.select("item_no", "start", "gram_item", "gram_start")), ["item_no", "start"])
    owners = wins.join(items.select("item_no", "item"), "item_no").select("gram_item", "gram_start", F.struct(F.col("item").cast("string").alias("id")).alias("item"))
    owners = stash(owners.distinct(), "window-owners")
    named = gram.select(*DOC, "gram_item", "gram_start").distinct().join(hinted(owners), ["gram_item", "gram_start"])
    return named.groupBy(*DOC).agg(F.array_sort(F.transform(F.collect_set("item"), lambda x: x["id"])).alias("_items"))


def near_items(postings: DataFrame, pairs: DataFrame, items: DataFrame, slop: int = NEAR) -> DataFrame:
    """Proximity matches: ``_id``, ``_hash``, item_no, item and ``gap``, the least distance, of the items
    whose two rarest words stand within ``slop`` words of each other, in any order. The two lists of
    a document are merged by position, so each posting meets its neighbour only."""
    order = Window.partitionBy(*DOC, "item_no").orderBy("pos")
    merged = postings.join(hinted(pairs), "term_no").select(*DOC, "item_no", "pos", "which")
    gap = F.when(F.lag("which").over(order) != F.col("which"), F.col("pos") - F.lag("pos").over(order))
    near = merged.withColumn("gap", gap).where(F.col("gap") <= slop).groupBy(*DOC, "item_no").agg(F.min("gap").alias("gap"))
    return near.join(hinted(items.select("item_no", "item")), "item_no")


def measured(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", near: bool = False
) -> DataFrame:
    """A written table of the documents that some window or, if ``near``, some proximity match hits:
    ``_id``, ``_hash``, n_hit (long), _items (array of strings) and n_near (long)."""
    items = item_words(benchmark, item, item_text)
    terms, placed = item_terms(items)
    index = build_index(documents, terms, key, text)
    counts = term_counts(index)
    wins = windows(placed, counts)
    pairs = rarest_pairs(placed, counts, terms) if near else None
    anchors = wins.select("item_no", F.explode("anchors").alias("at")).join(placed, ["item_no", "at"]).select("term_no")
    rare = stash((anchors.union(pairs.select("term_no")) if near else anchors).distinct(), "rare-terms")
    postings = stash(index.join(hinted(rare), "term_no", "left_semi"), "rare-postings")
    found = occurrences(index, alignments(postings, placed, wins), placed)
    zero = F.lit(0).cast("long")
    parts = hit_words(found).select(*DOC, "n_hit", F.lit(None).cast("array<string>").alias("_items"), zero.alias("n_near"))
    parts = parts.union(hit_items(found, wins, items).select(*DOC, zero, "_items", zero))
    if near:
        close = near_items(postings, pairs, items).groupBy(*DOC).agg(F.count_distinct(F.struct("item")).alias("n_near"))
        parts = parts.union(close.select(*DOC, zero, F.lit(None).cast("array<string>"), "n_near"))
    # one part alone has the items, so the greatest is the only one
    return stash(parts.groupBy(*DOC).agg(F.sum("n_hit").alias("n_hit"), F.max("_items").alias("_items"), F.sum("n_near").alias("n_near")), "hits")


def is_contaminated() -> Column:
    return (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))


def _counted(keyed: DataFrame, hits: DataFrame) -> DataFrame:
    """``keyed`` (with ``_id``, ``_hash`` and n_words) with the hits of each document, or none."""
    hits = hits.withColumnsRenamed({"_id": "_id2", "_hash": "_hash2"})
    joined = keyed.join(hits, same_document("_id2", "_hash2"), "left").drop("_id2", "_hash2")
    return joined.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long"))).withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Per document: n_words, n_hit (words inside occurring windows), n_items and items_sha256 (of
    the items that have such a window), contaminated, and n_near (items whose two rarest words,
    of those that the corpus has, stand within NEAR words of each other).

    Null and empty texts have no words and are clean; items without words are left out; repeated
    documents give a row each and repeated items count once; an item with a null id counts, as one,
    but is not in the hash; an empty benchmark leaves all clean. The texts are read twice (index and
    word counts); ids and counts alone are shuffled."""
    hits = measured(documents, benchmark, key, text, item, item_text, near=True)
    rows = _counted(document_keys(documents, key, text).select(*DOC, word_count(F.col("_text")).alias("n_words")), hits)
    items = F.coalesce("_items", F.array().cast("array<string>"))
    return rows.select(
        F.col("_id").alias(key),
        "n_words",
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
        "n_near",
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns. Words are counted in the hit
    documents only, and whole rows meet no more than the keys of those that go."""
    hits = measured(documents, benchmark, key, text).where("n_hit > 0").select(F.col("_id").alias("_id2"), F.col("_hash").alias("_hash2"), "n_hit")
    hits = stash(hits, "hit-documents")
    met = document_keys(documents, key, text).join(hinted(hits), same_document("_id2", "_hash2"))
    met = met.select(*DOC, word_count(F.col("_text")).alias("n_words"), "n_hit")
    gone = stash(met.where(is_contaminated()).select(F.col("_id").alias("_id2"), F.col("_hash").alias("_hash2")).distinct(), "contaminated")
    rows = documents.select(F.struct("*").alias("_row"))  # so that no column's name can clash
    here = F.col("_row")[key].eqNullSafe(F.col("_id2")) & (F.xxhash64(F.col("_row")[text]) == F.col("_hash2"))
    return rows.join(hinted(gone), here, "left_anti").select("_row.*")


def proximity(
    documents: DataFrame, benchmark: DataFrame, slop: int = NEAR, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The proximity matches by themselves: key, item and gap (see ``near_items``). Repeated documents
    are one; so are repeated items, by their least gap."""
    items = item_words(benchmark, item, item_text)
    terms, placed = item_terms(items)
    index = build_index(documents, terms, key, text)
    pairs = rarest_pairs(placed, term_counts(index), terms)
    postings = index.join(hinted(pairs.select("term_no").distinct()), "term_no", "left_semi").distinct()
    near = near_items(postings, pairs, items, slop)
    return near.groupBy(F.col("_id").alias(key), "_hash", "item").agg(F.min("gap").alias("gap")).select(key, "item", "gap")


CONTAMINATION_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
w AS (
  SELECT DISTINCT item_id, list_slice(words, i, i + least(len(words), {WINDOW}) - 1) AS gram
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(len(words), {WINDOW}) + 2)) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT len(gram) AS size FROM w),
g AS (
  SELECT k, i, size, list_slice(words, i, i + size - 1) AS gram
  FROM (SELECT k, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size)),
hits AS (SELECT k, i, size, item_id FROM g JOIN w USING (gram)),
covered AS (SELECT k, count(DISTINCT pos) AS n_hit FROM (SELECT k, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY k),
named AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY k),
p AS (SELECT k, unnest(words) AS term, unnest(range(len(words))) AS pos FROM d),
df AS (SELECT term, count(*) AS n FROM p GROUP BY term),
rare AS (
  SELECT DISTINCT item_id, words, term, row_number() OVER (PARTITION BY item_id, words ORDER BY n, term) AS which
  FROM (SELECT DISTINCT item_id, words, unnest(words) AS term FROM b) JOIN df USING (term) QUALIFY which <= 2),
couples AS (SELECT DISTINCT x.item_id, x.term AS one, y.term AS two FROM rare x JOIN rare y
  ON x.item_id IS NOT DISTINCT FROM y.item_id AND x.words = y.words AND x.which = 1 AND y.which = 2),
near AS (
  SELECT k, count(*) AS n_near FROM (
    SELECT DISTINCT p.k, c.item_id FROM couples c JOIN p ON p.term = c.one JOIN p q ON q.k = p.k AND q.term = c.two AND abs(q.pos - p.pos) <= {NEAR})
  GROUP BY k)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {ONE_IN} * coalesce(n_hit, 0) >= len(words) AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN covered USING (k) LEFT JOIN named USING (k) LEFT JOIN near USING (k)
"""
