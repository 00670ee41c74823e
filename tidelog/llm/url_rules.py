"""URL filtering by given rules and by mined association rules.

Spark's FP-growth mines the URL tokens of labelled pages together with their class. Tokens that
labelled pages have together or not at all are one item, so that tokens that always come together do
not multiply the itemsets. The rules that lead to the blocking class are pruned by support,
confidence (relative to the rate of all labelled pages) and redundancy. An inverted index from each
rule's rarest token finds the rules of a page: a rule applies where all its tokens are there. Pages
are matched once per distinct set of tokens. DataFrame functions and Spark ML only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ascii_lower, hinted, stash

#: The given rules, host and path.
GIVEN_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_PAGES = 10  # of the blocking class, at every size of the table
#: A rule's confidence has to be over the rate of all labelled pages by so many squared standard errors (95 %, one-sided).
MARGIN = 2.7
WIDE_ROWS = 50_000  # sets of tokens, or rules, that are broadcast
BLOCKED, ALLOWED = "=block", "=allow"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY_PART = r"(?s)\?([^#]*)"
DOCUMENT_NUMBER = r"/([0-9]{1,18})"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def url_document(path: Column) -> Column:
    """The number that a path has as its first segment of digits, or null: in the tables, the document
    whose text the page holds."""
    return F.regexp_extract(path, DOCUMENT_NUMBER, 1).try_cast("long")


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """The sorted distinct tokens of a URL: host labels ``h:``, path segments ``p:`` with numbers as
    ``0``, and query names ``q:``."""
    filled = lambda parts: F.filter(parts, lambda x: x != "")
    labels = F.transform(filled(F.split(host, r"\.")), lambda x: F.concat(F.lit("h:"), x))
    steps = filled(F.split(F.regexp_replace(path, "[0-9]+", "0"), "/"))
    steps = F.transform(steps, lambda x: F.concat(F.lit("p:"), x))
    query = F.coalesce(F.regexp_extract(url, QUERY_PART, 1), F.lit(""))
    names = F.transform(filled(F.split(query, "&")), lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1)))
    return F.array_sort(F.array_distinct(F.concat(labels, steps, names)))


def given_rule(host: Column, path: Column, rules=GIVEN_RULES) -> Column:
    """The longest given rule that fits, as ``struct(rule, verdict)``, or null. A rule fits its host
    and all subdomains if the path starts with the rule's. The list is part of the plan, so it is
    meant for tens of rules."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def merged_tokens(labelled_pages: DataFrame) -> DataFrame:
    """token and ``item``: the least of the tokens that stand in the same labelled pages as it. Sets of
    pages are compared by their size and two sums of 64-bit hashes."""
    spread = labelled_pages.select(F.explode("tokens").alias("token"), F.xxhash64("page_id", "tokens").alias("_a"), F.xxhash64("tokens", "page_id").alias("_b"))
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("_a", "_b")]
    sets = spread.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *sums)
    least = sets.groupBy("n", "_a", "_b").agg(F.min("token").alias("item"))
    return stash(sets.join(least, ["n", "_a", "_b"]).select("token", "item"), "url-items")


def transactions(labelled_pages: DataFrame) -> DataFrame:
    """``items`` of each labelled page: its merged tokens and its class. A page without tokens has its
    class only."""
    merged = merged_tokens(labelled_pages)
    rows = stash(labelled_pages.select(F.monotonically_increasing_id().alias("_row"), "tokens", "bad"), "labelled-pages")
    items = rows.select("_row", F.explode("tokens").alias("token")).join(hinted(merged), "token").groupBy("_row").agg(F.collect_set("item").alias("_items"))
    kind = F.when(F.col("bad"), F.lit(BLOCKED)).otherwise(F.lit(ALLOWED))
    joined = rows.join(items, "_row", "left").select(F.array_append(F.coalesce("_items", F.array().cast("array<string>")), kind).alias("items"))
    return stash(joined, "transactions")


RULES = "tokens array<string>, pages long, blocked long, confidence double"


def mine_rules(found: DataFrame, min_pages: int = MIN_PAGES, margin: float = MARGIN) -> DataFrame:
    """Rules ``tokens`` -> blocked with the pages that have the tokens, those of them that are blocked,
    and confidence, from ``transactions``. A rule needs ``min_pages`` blocked pages and a
    confidence over the rate of all pages by the margin; it goes if a rule with one of its tokens
    less is as confident. FP-growth brings the frequent tokens to the driver: at most the number of
    tokens of labelled pages by ``min_pages``."""
    spark = found.sparkSession
    n, bad = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.array_contains("items", BLOCKED).cast("long")), F.lit(0))).first()
    if bad < min_pages:
        return spark.createDataFrame([], RULES)
    model = FPGrowth(itemsCol="items", minSupport=(min_pages - 0.5) / n, minConfidence=0.0).fit(found)
    to_block = model.associationRules.where((F.element_at("consequent", 1) == BLOCKED) & (F.size("antecedent") > 0))
    counted = to_block.select(
        F.array_sort("antecedent").alias("tokens"),
        F.round(F.col("support") * n / F.col("confidence")).cast("long").alias("pages"),
        F.round(F.col("support") * n).cast("long").alias("blocked"),
    )
    over = F.col("blocked").cast("double") * n - F.col("pages").cast("double") * bad
    rest = F.col("blocked").cast("double") * (F.col("pages") - F.col("blocked")).cast("double")
    sure = (over > 0) & (over * over * F.col("pages").cast("double") > F.lit(margin) * rest * F.lit(float(n)) * F.lit(float(n)))
    rules = stash(counted.where(sure).withColumn("confidence", F.col("blocked") / F.col("pages")), "url-rules")
    less = rules.select("tokens", "confidence", F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("part"))
    wider = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("_other"))
    dropped = less.join(wider, "part").where(F.col("_other") >= F.col("confidence")).select("tokens").distinct()
    return stash(rules.join(dropped, "tokens", "left_anti"), "pruned-rules")


def labelled(tokens: DataFrame, labels: DataFrame) -> DataFrame:
    """The pages that have a label under ``_document``, with ``bad``: low quality or toxic is blocked.
    Several labels of a document count as blocked if any is."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    known = labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull())
    classes = known.groupBy(F.col("doc_id").alias("_document")).agg(F.max(bad).alias("bad"))
    return tokens.join(classes, "_document").select("page_id", "tokens", "bad")


def rule_index(rules: DataFrame) -> DataFrame:
    """The inverted index: each rule under its token that the fewest labelled pages have with it, which
    is the one of the fewest rules where they tie: ``token`` and ``rule``."""
    uses = rules.select("tokens", F.explode("tokens").alias("token"))
    shared = stash(uses.groupBy("token").agg(F.count(F.lit(1)).alias("_uses")), "rule-tokens")
    rarest = uses.join(hinted(shared), "token").groupBy("tokens").agg(F.min(F.struct("_uses", "token"))["token"].alias("token"))
    rule = F.struct(F.col("confidence"), F.array_join("tokens", " ").alias("text"))
    return stash(rarest.join(rules, "tokens").select("token", "tokens", rule.alias("rule")), "rule-index")


def match_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct ``tokens`` that some rule applies to: the most confident rule's
    ``mined_rule`` (its tokens, space-joined; ties by text)."""
    index = rule_index(rules).select("token", F.col("tokens").alias("_needed"), "rule")
    distinct = token_sets.select("tokens").distinct()
    hits = distinct.select("tokens", F.explode("tokens").alias("token")).join(hinted(index, WIDE_ROWS), "token")
    full = hits.where(F.size(F.array_except("_needed", "tokens")) == 0)
    return full.groupBy("tokens").agg(F.max("rule").alias("_best")).select("tokens", F.col("_best.text").alias("mined_rule"))


def judge_urls(
    pages: DataFrame, labels: DataFrame, min_pages: int = MIN_PAGES, margin: float = MARGIN, rules=GIVEN_RULES, document: Column | None = None
) -> DataFrame:
    """Per page: page_id, host, path, rule (the longest given one that fits, or null), verdict (its,
    else ``block`` if a mined rule applies, else ``allow``) and mined_rule (or null). Null URLs and
    URLs without ``://`` have empty host and path and no tokens. Without labels nothing is mined.
    Repeated rows give a row each. ``document`` (over page_id, url, host and path) is the id by which a
    page is labelled; the page's own by default."""
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    parsed = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    labelled_by = F.col("page_id") if document is None else document
    tokens = parsed.select(
        "page_id", "host", "path", labelled_by.alias("_document"), url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")
    )
    mined = match_rules(tokens, mine_rules(transactions(labelled(tokens, labels)), min_pages, margin))
    given = given_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    judged = tokens.join(hinted(stash(mined, "url-matches"), WIDE_ROWS), "tokens", "left").withColumn("_given", given)
    verdict = F.coalesce("_given.verdict", by_method).alias("verdict")
    return judged.select("page_id", "host", "path", F.col("_given.rule").alias("rule"), verdict, "mined_rule")


def _given_sql() -> tuple[str, str]:
    when = []
    for verdict, h, p in sorted(GIVEN_RULES, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
        when.append((fits, h + p, verdict))
    case = lambda k: "CASE " + " ".join(f"WHEN {w[0]} THEN '{w[k]}'" for w in when) + " END"
    return case(1), case(2)


JUDGE_SQL = rf"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
t AS (
  SELECT page_id, host, path, TRY_CAST(regexp_extract(path, '{DOCUMENT_NUMBER}', 1) AS BIGINT) AS document, list_sort(list_distinct(list_concat(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
    list_transform(list_filter(string_split(regexp_replace(path, '[0-9]+', '0', 'g'), '/'), lambda x: x <> ''), lambda x: 'p:' || x),
    list_transform(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1, 's'), '&'), lambda x: x <> ''),
                   lambda x: 'q:' || string_split(x, '=')[1])))) AS tokens
  FROM u),
classes AS (
  SELECT doc_id AS document, max(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
known AS (SELECT row_number() OVER () AS k, tokens, bad FROM t JOIN classes USING (document)),
places AS (SELECT token, list(k ORDER BY k) AS ks FROM (SELECT k, unnest(tokens) AS token FROM known) GROUP BY token),
merged AS (SELECT token, min(token) OVER (PARTITION BY ks) AS item FROM places),
items AS (
  SELECT k, list(DISTINCT item) AS items FROM (SELECT k, unnest(tokens) AS token FROM known) JOIN merged USING (token) GROUP BY k),
subsets AS (
  SELECT bad, list_sort(list_filter(items, lambda x, i: (mask >> (i - 1)) & 1 = 1)) AS part
  FROM (SELECT items, bad, unnest(range(1, CAST(2 ** len(items) AS BIGINT))) AS mask FROM known JOIN items USING (k))),
totals AS (SELECT CAST(count(*) AS DOUBLE) AS all_n, CAST(count(*) FILTER (WHERE bad) AS DOUBLE) AS all_bad FROM known),
counted AS (
  SELECT part, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE bad) AS DOUBLE) AS b FROM subsets GROUP BY part
  HAVING count(*) FILTER (WHERE bad) >= {MIN_PAGES}),
sure AS (
  SELECT part, b / n AS confidence FROM counted, totals
  WHERE b * all_n - n * all_bad > 0
    AND (b * all_n - n * all_bad) * (b * all_n - n * all_bad) * n > {MARGIN} * (b * (n - b)) * all_n * all_n),
less AS (SELECT part, confidence, list_filter(part, lambda y: y <> x) AS smaller FROM (SELECT part, confidence, unnest(part) AS x FROM sure)),
mined AS (
  SELECT part, confidence FROM sure
  WHERE part NOT IN (SELECT l.part FROM less l JOIN sure s ON l.smaller = s.part WHERE s.confidence >= l.confidence)),
matched AS (
  SELECT t.tokens, max({{'c': confidence, 'r': array_to_string(part, ' ')}}).r AS mined_rule
  FROM (SELECT DISTINCT tokens FROM t) t JOIN mined m ON list_has_all(t.tokens, m.part) GROUP BY t.tokens)
SELECT page_id, host, path, {_given_sql()[0]} AS rule,
       coalesce({_given_sql()[1]}, CASE WHEN m.mined_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, m.mined_rule
FROM t LEFT JOIN matched m ON t.tokens = m.tokens
"""
