"""Self-join of documents by the Jaccard similarity of their word n-grams, with a token-group matrix.

Sets of n and m tokens link only if they share at least 85 (n + m) / 185 tokens, so a set of n links
only if it shares all but 15 % of its tokens with another one.

1. A share of all tokens, by hash (``sampled_share``), tells which documents can link at all: enough
   of its sampled tokens have to occur in other documents. Equal sets are joined to their least one.
2. The other documents' tokens are counted among themselves and ordered, rarest first. At the first
   token that two linked sets share, at positions i and j, both n - i and m - j tokens are left and
   must reach the share asked for. So these first tokens of each set index it, with the greatest
   partner size that it can still link to from there (``reach``).
3. The documents are partitioned into groups of similar ones: each goes to that of its index tokens
   which most documents have. The token-group matrix holds the union of each group's tokens.
4. A document asks the groups where its index tokens lead. It can only link to a member of a group if
   all but 15 % of its tokens are in the group's row of the matrix. Groups that reach this bound,
   and its own, are opened, and it is compared with the leaders that it was led to, the members with
   the smallest share of tokens of their own. Links so found merge groups.
5. Where an index token still leads from one merged group to another, the matrix of the merged
   groups is asked again, and the opened groups' members are compared.

No pair that can link is left out, and no group is expanded into all its pairs: inside a merged group
the links that made it stand for all. Pairs are compared by their sets of 64-bit tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches, hinted, stash
from tidelog.llm.components import components

SHINGLE = 4
PERCENT = 85
REMEMBERED = 1 << 16
COMMON, COMMON_MOST = 0.01, 1_000_000
EVERYWHERE = 1 << 40  # stands for the count of a common token


def text_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_set(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The distinct n-grams; the whole sequence if it is shorter; empty without words."""
    words = text_words(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size)), strict=False))


class ShingleHashes:
    """64-bit hashes of a text's distinct n-grams, as a sorted array."""

    def __init__(self, size: int):
        self.size, self.memory = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = text_words(text)
        if len(self.memory) > REMEMBERED:
            self.memory = {}
        known = self.memory
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        width = min(self.size, len(h))
        out = np.full(len(h) - width + 1, len(h) if len(h) < self.size else 0, np.uint64)
        for k in range(width):
            out = (out ^ h[k : len(h) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)


def sampled_share(percent: int) -> int:
    """How many tokens in a hundred, by hash, tell which documents can link: a third more than may be
    missing in a set that links, so that a quarter of a document's sampled tokens has to be shared."""
    return min(100, -(-(100 - percent) * 4 // 3))


def slack(n, percent: int):
    """How many tokens of a set of n may be missing in a set that it links to."""
    return n - F.floor((n * percent + 99) / 100)


def sampled_rows(documents: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """Rows (token, doc, times) for the sampled tokens, and one row without token for each document,
    with n, s (sampled tokens), ``known`` and 128 bits of hash of its set. A token that several
    documents of a batch have is known to be shared: it is counted in ``known``, and one row
    without document stands for all, so that a token that is everywhere has a row for each batch."""
    share = np.uint64(sampled_share(percent))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = ShingleHashes(size)
        for b in batches:
            sets = [hashes(t) for t in b["_text"]]
            chosen = [x[x % np.uint64(100) < share] for x in sets]
            lengths = np.array([len(x) for x in chosen], np.int64)
            docs = b["_doc"].to_numpy()
            token, back, times = np.unique(np.concatenate(chosen).view(np.int64), return_inverse=True, return_counts=True)
            shared = times[back] > 1
            known = np.add.reduceat(np.r_[shared, False].astype(np.int64), np.cumsum(lengths) - lengths) * (lengths > 0)
            alone = token[back[~shared]], np.repeat(docs, lengths)[~shared]
            yield pd.DataFrame({"token": alone[0], "doc": alone[1], "times": 1, "n": 0, "s": 0, "known": 0, "h1": 0, "h2": 0})
            many = times > 1
            none = pd.array([None] * int(many.sum()), dtype="Int64")
            yield pd.DataFrame({"token": token[many], "doc": none, "times": times[many], "n": 0, "s": 0, "known": 0, "h1": 0, "h2": 0})
            digests = np.array([np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), np.int64) for x in sets])
            none = pd.array([None] * len(sets), dtype="Int64")
            n = [len(x) for x in sets]
            yield pd.DataFrame({"token": none, "doc": docs, "times": 0, "n": n, "s": lengths, "known": known, "h1": digests[:, 0], "h2": digests[:, 1]})

    rows = bounded_batches(documents).where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("_doc"), F.col(text).alias("_text"))
    return rows.mapInPandas(run, "token long, doc long, times long, n long, s long, known long, h1 long, h2 long")


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Per document: n, ``same`` (the least document of an equal set) and ``open``, whether it can link
    to a different set. Where ids repeat, the larger set counts."""
    apart = F.when(F.col("token").isNull(), F.col("doc"))  # rows without token are not to meet in one task
    spread = rows.withColumn("df", F.when(F.col("token").isNotNull(), F.sum("times").over(Window.partitionBy("token", apart))))
    docs = spread.where(F.col("doc").isNotNull()).groupBy("doc").agg(
        *[F.max(c).alias(c) for c in ("n", "s", "known")],
        F.max(F.struct("n", "h1", "h2")).alias("h"),
        F.sum((F.col("df") > 1).cast("long")).alias("shared"),
    )
    docs = stash(docs, "sampled-sets")
    least = docs.where("n > 0").groupBy("h").agg(F.min("doc").alias("_same"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    enough = F.coalesce("shared", F.lit(0)) + F.col("known") >= F.col("s") - slack(F.col("n"), percent)
    joined = docs.join(stash(least.select("h", "_same"), "equal-sets"), "h", "left")
    return joined.select("doc", "n", F.coalesce("_same", "doc").alias("same"), (enough & (F.col("n") > 0)).alias("open"))


def common_tokens(texts: DataFrame, size: int) -> np.ndarray:
    """Tokens that at least a share COMMON of the documents have, as far as batches show it: a sorted
    array of at most (tokens per document) / COMMON, and at most COMMON_MOST, the most common ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = ShingleHashes(size)
        for b in batches:
            token, times = np.unique(np.concatenate([hashes(t) for t in b["text"]]).view(np.int64), return_counts=True)
            often = times >= max(2, COMMON * len(b) / 2)
            yield pd.DataFrame({"token": token[often], "times": times[often]})

    counts = bounded_batches(texts).mapInPandas(run, "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    often = counts.where(F.col("times") >= F.lit(max(2, COMMON * texts.count())))
    return np.array(sorted(r["token"] for r in often.orderBy(F.desc("times")).limit(COMMON_MOST).collect()), np.int64)


def all_rows(texts: DataFrame, size: int, common: np.ndarray) -> DataFrame:
    """Rows (token, salt, doc, n) for all tokens; n is 0 but in the first row of each document. For the
    common tokens the salt is the document, else -1."""
    shared = texts.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, often = ShingleHashes(size), shared.value
        for b in batches:
            sets = [hashes(t) for t in b["text"]]
            lengths = np.array([len(x) for x in sets], np.int64)
            n = np.zeros(int(lengths.sum()), np.int64)
            filled = lengths > 0
            n[(np.cumsum(lengths) - lengths)[filled]] = lengths[filled]
            token, doc = np.concatenate(sets).view(np.int64), np.repeat(b["doc"].to_numpy(), lengths)
            yield pd.DataFrame({"token": token, "salt": np.where(np.isin(token, often), doc, -1), "doc": doc, "n": n})

    return bounded_batches(texts).mapInPandas(run, "token long, salt long, doc long, n long")


def ordered_tokens(rows: DataFrame, percent: int) -> DataFrame:
    """Per document that can link: n, own (tokens that no other has) and ``tokens`` (the others, rarest
    first). Common tokens come last, as their rows are not gathered for a count."""
    count = F.count(F.lit(1)).over(Window.partitionBy("token", "salt"))
    spread = rows.withColumn("df", F.when(F.col("salt") == -1, count).otherwise(F.lit(EVERYWHERE)))
    kept = spread.where((F.col("df") > 1) | (F.col("n") > 0))
    docs = kept.groupBy("doc").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_set(F.when(F.col("df") > 1, F.struct("df", "token")))).alias("shared")
    )
    docs = docs.select("doc", "n", (F.col("n") - F.size("shared")).alias("own"), F.transform("shared", lambda x: x["token"]).alias("tokens"))
    return docs.where(F.col("own") <= slack(F.col("n"), percent))


def index_rows(docs: DataFrame, percent: int) -> DataFrame:
    """Rows (token, doc, n, reach, share): the tokens of a document that may be the first it has in
    common with a linked one, and the greatest size of that one."""
    first = F.slice("tokens", F.lit(1), (slack(F.col("n"), percent) - F.col("own") + 1).cast("int"))
    rows = docs.select("doc", "n", "own", F.posexplode(first).alias("at", "token"))
    left = F.col("n") - F.col("own") - F.col("at")
    reach = F.floor(left * (100 + percent) / percent) - F.col("n")
    return rows.select("token", "doc", "n", reach.alias("reach"), (F.col("own") / F.col("n")).alias("share"))


def verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. Tokens of a document's own are in no other."""
    one = docs.select(F.col("doc").alias("a"), F.col("n").alias("_na"), F.col("tokens").alias("_ta"))
    two = docs.select(F.col("doc").alias("b"), F.col("n").alias("_nb"), F.col("tokens").alias("_tb"))
    common = F.size(F.array_intersect("_ta", "_tb"))
    linked = 100 * common >= percent * (F.col("_na") + F.col("_nb") - common)
    return pairs.join(one, "a").join(two, "b").where(linked).select("a", "b")


def _fits(reach, n, other_reach, other_n):
    return (F.col(n) <= F.col(other_reach)) & (F.col(other_n) <= F.col(reach))


def partition(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``led`` (doc, n, b): each document with the leaders of its index tokens that it may link to, and
    the partition (doc, group) of all documents into groups, named after an index token."""
    leads = index.groupBy("token").agg(F.min(F.struct("share", "doc", "n", "reach")).alias("lead"), F.count(F.lit(1)).alias("members"))
    leads = leads.where("members > 1").select("token", "members", F.col("lead.doc").alias("b"), F.col("lead.n").alias("_n"), F.col("lead.reach").alias("_reach"))
    leads = stash(leads, "leaders")  # a written side lets Spark split the other where a token has many rows
    met = stash(index.join(leads, "token"), "led-rows")
    led = met.where((F.col("doc") != F.col("b")) & _fits("reach", "n", "_reach", "_n")).select("doc", "b").distinct()
    groups = met.groupBy("doc").agg(F.max(F.struct("members", "token")).alias("most")).select("doc", F.col("most.token").alias("group"))
    return led, stash(groups, "partition")


def open_groups(docs: DataFrame, asks: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Of the questions ``asks`` (doc, other) those whose group qualifies: the token-group matrix. Its
    rows are the tokens of each group that is asked, from ``members`` (doc, group); a question's
    overlap with its group's row has to reach the least number of tokens that a link shares."""
    wanted = stash(asks.select(F.col("other").alias("group")).distinct(), "asked-groups")
    inside = members.join(wanted, "group", "left_semi").join(docs.select("doc", "tokens"), "doc")
    matrix = stash(inside.select(F.col("group").alias("other"), F.explode("tokens").alias("token")).distinct(), "token-group-matrix")
    asked = asks.join(docs.select("doc", "n", "tokens"), "doc")
    hits = asked.select("doc", "other", "n", F.explode("tokens").alias("token")).join(matrix, ["other", "token"])
    bound = F.col("n") - slack(F.col("n"), percent)
    overlap = hits.groupBy("doc", "other", "n").agg(F.count(F.lit(1)).alias("overlap"))
    return stash(overlap.where(F.col("overlap") >= bound).select("doc", "other"), "opened")


def leader_pairs(docs: DataFrame, led: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a document and a leader in its own group or another that it opens."""
    own = groups.select("doc", F.col("group").alias("_own"))
    there = groups.select(F.col("doc").alias("b"), F.col("group").alias("other"))
    placed = stash(led.join(own, "doc").join(there, "b"), "led-pairs")
    foreign = placed.where(F.col("other") != F.col("_own"))
    opened = open_groups(docs, stash(foreign.select("doc", "other").distinct(), "questions"), groups, percent)
    pairs = placed.where(F.col("other") == F.col("_own")).select("doc", "b").union(foreign.join(opened, ["doc", "other"]).select("doc", "b"))
    return stash(pairs.select(F.col("doc").alias("a"), "b"), "leader-pairs")


def member_pairs(docs: DataFrame, index: DataFrame, groups: DataFrame, done: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different merged groups that may link, where one opens the other's group.
    The smaller group asks."""
    placed = index.join(groups, F.col("doc") == F.col("node"), "left").withColumn("group", F.coalesce("component", "doc"))
    placed = stash(placed.select("token", "doc", "n", "reach", "group"), "placed")
    mixed = placed.groupBy("token").agg(F.min("group").alias("_low"), F.max("group").alias("_high"))
    mixed = stash(mixed.where(F.col("_low") != F.col("_high")).select("token"), "mixed-tokens")
    inside = placed.join(mixed, "token", "left_semi")
    extent = placed.groupBy("group").agg(F.count_distinct("doc").alias("extent"))
    sized = stash(inside.join(stash(extent, "extents"), "group"), "mixed-rows")
    parts = sized.groupBy("token", "group", "extent").agg(F.min("n").alias("least"), F.max("reach").alias("most"))
    parts = stash(parts.select("token", F.col("group").alias("other"), F.col("extent").alias("o_extent"), "least", "most"), "parts")
    smaller = F.struct("extent", "group") < F.struct(F.col("o_extent").alias("extent"), F.col("other").alias("group"))
    asks = sized.join(parts, "token").where(smaller & _fits("reach", "n", "most", "least"))
    asks = stash(asks.select("doc", "other").distinct(), "questions")
    opened = open_groups(docs, asks, placed.select("doc", "group").distinct(), percent)
    right = sized.select(F.col("token").alias("_token"), F.col("doc").alias("b"), F.col("n").alias("_n"), F.col("reach").alias("_reach"), F.col("group").alias("_group"))
    met = sized.join(opened, "doc").join(right, (F.col("token") == F.col("_token")) & (F.col("other") == F.col("_group")))
    more = met.where(_fits("reach", "n", "_reach", "_n")).select(F.col("doc").alias("a"), "b").distinct()
    known = done.select("a", "b").union(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return stash(more.join(known, ["a", "b"], "left_anti"), "member-pairs")


def similar_groups(
    documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """``(sizes, groups)``: doc, n (0 for texts without words) and ``same``, the least document of an
    equal set; and node and component (least document reachable by links) of the documents that
    stand for their set and have a link."""
    sizes = stash(candidates(sampled_rows(documents, key, text, size, percent), percent), "set-sizes")
    chosen = stash(sizes.where(F.col("open") & (F.col("doc") == F.col("same"))).select("doc"), "candidates")
    texts = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    texts = stash(texts.join(hinted(chosen), "doc", "left_semi"), "candidate-texts")
    docs = stash(ordered_tokens(all_rows(texts, size, common_tokens(texts, size)), percent), "candidate-sets")
    index = stash(index_rows(docs, percent), "index")
    led, parts = partition(index)
    pairs = leader_pairs(docs, led, parts, percent)
    links = stash(verified(pairs, docs, percent), "links")
    groups = stash(components(links), "groups")
    late = stash(verified(member_pairs(docs, index, groups, pairs, percent), docs, percent), "late-links")
    if not late.isEmpty():
        groups = stash(components(links.union(late)), "groups")
    return sizes.select("doc", "n", "same"), groups


def set_sizes(documents: DataFrame, text: str, size: int) -> DataFrame:
    """``_n``, the size of each row's set, in place of its other columns."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = ShingleHashes(size)
        for b in batches:
            yield pd.DataFrame({"_n": [len(hashes(t)) for t in b["_text"]]})

    return bounded_batches(documents).select(F.col(text).alias("_text")).mapInPandas(run, "_n long")


def join_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: n_shingles and component_id (the least id reachable by links, itself included).

    Null and empty texts have no shingles and no links. Rows that repeat an id are one document with
    the larger of their sets' sizes, and each gives a row; a row without an id has its set's size,
    no links and no component."""
    sizes, groups = similar_groups(documents, key, text, size, percent)
    rows = documents.where(F.col(key).isNotNull()).select(F.col(key).alias(key), F.col(key).cast("long").alias("_id"))
    rows = rows.join(sizes, F.col("_id") == F.col("doc"), "left").join(groups, F.col("same") == F.col("node"), "left")
    rows = rows.select(key, F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "same").alias("component_id"))
    nameless = set_sizes(documents.where(F.col(key).isNull()), text, size)
    return rows.union(nameless.select(F.lit(None).cast(documents.schema[key].dataType), "_n", F.lit(None).cast("long")))


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``documents`` without those that link, directly or over others, to one of a lesser id. Rows that
    repeat an id and its text are one; those that repeat an id with another text are documents of
    their own, after all others. Documents without words or id all stay."""
    rows = documents.select(F.struct("*").alias("_row"))  # so that no column's name can clash
    id_ = F.col("_row")[key]
    rows = rows.select("_row", id_.cast("long").alias("_k"), F.col("_row")[text].alias("_t"))
    counts = documents.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("_again")).agg(F.count(F.lit(1)).alias("_times"))
    again = stash(counts.where("_times > 1").select("_again"), "repeated-ids")
    if not again.isEmpty():
        again, here = hinted(again), F.col("_k") == F.col("_again")
        beyond = documents.agg(F.max(F.col(key).cast("long"))).first()[0] + 1
        first = F.row_number().over(Window.partitionBy("_k", "_t").orderBy(F.to_json("_row")))
        doubled = rows.join(again, here, "left_semi").withColumn("_first", first).where("_first = 1")
        doubled = stash(doubled.select("_row", (F.lit(beyond) + F.monotonically_increasing_id()).alias("_k"), "_t"), "repeated-rows")
        rows = rows.join(again, here, "left_anti").union(doubled)
    sizes, groups = similar_groups(rows, "_k", "_t", size, percent)
    least = sizes.join(groups, F.col("same") == F.col("node"), "left").withColumn("least", F.coalesce("component", "same"))
    gone = stash(least.where(F.col("doc") != F.col("least")).select(F.col("doc").alias("_gone")), "gone")
    return rows.join(hinted(gone), F.col("_k") == F.col("_gone"), "left_anti").select("_row.*")


JOIN_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, list_slice(words, i, i + {SHINGLE - 1}) AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {SHINGLE - 2}, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
  WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = d.doc_id
"""
