"""Quality rules with host-level verdicts.

Measures of every whole text decide its rules. The failures of each rule are counted by host, the
rates shrunk towards all hosts' by a beta prior fitted to that rule's rates (method of moments), and
each host's verdict, on any rule, is joined back to its documents. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import WORD_SEPARATOR, stash

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
SYMBOL_PERCENT = 10  # symbols in a hundred words
LINE_PERCENT = 30  # repeated lines in a hundred
#: Rules by name; the base rules also fail a document by themselves.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {REPEAT_PERCENT} * n_words",
    "symbols": f"100 * n_symbols > {SYMBOL_PERCENT} * n_words",
    "dup_lines": f"100 * n_dup_lines > {LINE_PERCENT} * n_lines",
}
BASE_RULES = ("few_words", "repeats")
HOST_LIMIT = 0.5  # a host fails where its shrunk rate of failures of some rule is over this
WEAKEST_PRIOR, STRONGEST_PRIOR = 10.0, 1e6  # bounds of the prior's weight, in documents


def measures(documents: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text") -> DataFrame:
    """Key, host and measures of each whole text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, base_failed. A null text has no words, lines or symbols.

    Windows of WINDOW words are compared by a 64-bit hash of their words' hashes. Most texts repeat
    none, which a set of the hashes shows; in the others a sort brings equal hashes together, and
    the union of their windows is counted from the sorted starts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = documents.select(
        F.col(key).alias(key),
        F.col(host).alias("_host"),
        F.filter(F.split(whole, WORD_SEPARATOR), lambda w: w != "").alias("_words"),
        F.regexp_count(whole, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    rows = rows.select(
        key,
        "_host",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashed"),
    )
    windows = F.when(
        F.size("_hashed") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_hashed") - WINDOW),
            lambda i: F.xxhash64(*[F.get(F.col("_hashed"), i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_windows", windows)
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_placed", F.when(repeats, placed))
    twice = F.filter(
        "_placed",
        lambda x, k: (F.get(F.col("_placed"), k + 1)["h"].eqNullSafe(x.h))
        | (F.get(F.col("_placed"), k - 1)["h"].eqNullSafe(x.h)),
    )
    rows = rows.withColumn("_starts", F.sort_array(F.transform(twice, lambda x: x.i)))
    covered = F.transform(
        "_starts",
        lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_starts"), k + 1) - i, F.lit(WINDOW))),
    )
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    rows = rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))
    failed = F.expr(" OR ".join(RULES[r] for r in BASE_RULES))
    return rows.select(
        key, "_host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", failed.alias("base_failed")
    )


def host_verdicts(measured: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Per host: its documents, the failures and shrunk rate of each rule (``failed_`` and ``rate_``), and
    whether it fails one. A prior's mean is the rule's rate of all documents; its weight comes from
    the variance of the hosts' rates beyond what sampling explains. A null host is a host of its own."""
    failures = [F.sum(F.expr(rule).cast("long")).alias(f"failed_{name}") for name, rule in RULES.items()]
    hosts = measured.groupBy("_host").agg(F.count(F.lit(1)).alias("n"), *failures)
    moments = [F.avg(F.lit(1.0) / F.col("n")).alias("inverse")]
    for name in RULES:
        moments.append((F.sum(f"failed_{name}") / F.sum("n")).alias(f"mean_{name}"))
        moments.append(F.coalesce(F.var_pop(F.col(f"failed_{name}") / F.col("n")), F.lit(0.0)).alias(f"spread_{name}"))
    overall = hosts.agg(*moments)
    priors = []
    for name in RULES:
        mean = F.col(f"mean_{name}")
        binomial = mean * (1 - mean)
        extra = F.col(f"spread_{name}") - binomial * F.col("inverse")
        weight = F.when((extra > 0) & (binomial > 0), binomial / F.when(extra > 0, extra) - 1).otherwise(F.lit(STRONGEST_PRIOR))
        weight = F.least(F.greatest(weight, F.lit(WEAKEST_PRIOR)), F.lit(STRONGEST_PRIOR))
        priors += [mean, weight.alias(f"weight_{name}")]
    joined = hosts.join(F.broadcast(overall.select(*priors)))  # one row
    for name in RULES:
        weight = F.col(f"weight_{name}")
        joined = joined.withColumn(f"rate_{name}", (F.col(f"failed_{name}") + F.col(f"mean_{name}") * weight) / (F.col("n") + weight))
    kept = [c for name in RULES for c in (f"failed_{name}", f"rate_{name}")]
    failed = F.greatest(*[F.col(f"rate_{name}") for name in RULES]) > limit
    return joined.select(F.col("_host").alias("_host_key"), "n", *kept, failed.alias("host_failed"))


def judge(documents: DataFrame, key: str = "doc_id", host: str = "source", text: str = "text", limit: float = HOST_LIMIT) -> DataFrame:
    """Measures of each document and ``kept``: false where the base rules fail, else whether the host's
    shrunk rates are within the limit for all rules. Repeated rows give a row each.

    The measures are written once, so that the texts are read once; the counts by host are combined
    before their shuffle."""
    measured = stash(measures(documents, key, host, text), "quality")
    verdicts = host_verdicts(measured, limit)
    joined = measured.join(verdicts, F.col("_host").eqNullSafe(F.col("_host_key")), "left")
    return joined.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
    )


JUDGE_SQL = rf"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
numbered AS (SELECT *, row_number() OVER () AS k FROM t),
windows AS (
  SELECT k, i, list_slice(words, i, i + {WINDOW - 1}) AS w
  FROM (SELECT k, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM numbered WHERE len(words) >= {WINDOW})),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS c FROM windows) WHERE c > 1),
covered AS (
  SELECT k, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS n
  FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS following FROM twice) GROUP BY k),
m AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM numbered LEFT JOIN covered c USING (k)),
b AS (SELECT *, {" OR ".join(RULES[r] for r in BASE_RULES)} AS base_failed FROM m),
hosts AS (SELECT source, count(*) AS n, {", ".join(f"sum(({rule})::INT) AS failed_{name}" for name, rule in RULES.items())} FROM b GROUP BY source),
long AS ({" UNION ALL ".join(f"SELECT source, n, '{name}' AS rule, failed_{name} AS failed FROM hosts" for name in RULES)}),
overall AS (
  SELECT rule, sum(failed) / sum(n) AS mean, var_pop(failed / n) AS spread, avg(1.0 / n) AS inverse FROM long GROUP BY rule),
prior AS (
  SELECT rule, mean, least(greatest(CASE WHEN spread - mean * (1 - mean) * inverse > 0 AND mean * (1 - mean) > 0
    THEN mean * (1 - mean) / (spread - mean * (1 - mean) * inverse) - 1 ELSE {STRONGEST_PRIOR} END, {WEAKEST_PRIOR}), {STRONGEST_PRIOR}) AS weight
  FROM overall),
verdicts AS (
  SELECT source, bool_or((failed + mean * weight) / (n + weight) > {HOST_LIMIT}) AS host_failed FROM long JOIN prior USING (rule) GROUP BY source)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT host_failed AS kept
FROM b JOIN verdicts v ON b.source IS NOT DISTINCT FROM v.source
"""
