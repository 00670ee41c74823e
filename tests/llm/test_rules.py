"""URL rules, quality rules and chats."""

import collections

import pytest

from tidelog.llm import chat, quality, queries, url_rules

from .conftest import TEXTS

PAGES = "page_id long, url string, html string, host string, tokens string, rule string"
LABELS = "doc_id long, quality int, toxic int"


def pages(spark, *urls):
    return spark.createDataFrame([(i, u, None, None, None, None) for i, u in enumerate(urls)], PAGES)


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.ORG/es/1?x#y", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("https://notexample.org/es/2", "notexample.org", "/es/2", "org/", "allow"),
        ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"),
        ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
        ("http://x.com/FR/a", "x.com", "/FR/a", None, "allow"),
        ("http://x.org", "x.org", "", None, "allow"),
        ("http://x.org?q=/es/", "x.org", "", None, "allow"),
        ("x.org/es/", "", "", None, "allow"),
        ("a://b://c.org/x", "b:", "//c.org/x", None, "allow"),
        ("http://x.org\n/es/#?", "x.org\n", "/es/", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_given_rules(spark, url, host, path, rule, verdict):
    labels = spark.createDataFrame([], LABELS)
    r = url_rules.judge_urls(pages(spark, url), labels).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_mined_rules_block_what_the_labels_show(spark):
    urls = [f"http://s{i % 4}.spam.net/{i}?win=1" if i % 2 else f"http://s{i % 4}.good.net/{i}?win=1" for i in range(80)]
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, None) for i in range(60)] + [(0, None, None)], LABELS)
    got = url_rules.judge_urls(pages(spark, *urls, None), labels).collect()
    assert all(r.verdict == ("block" if "spam" in r.host else "allow") for r in got)
    tokens = pages(spark, *urls)
    host, path = url_rules.url_host(tokens.url), url_rules.url_path(tokens.url)
    tokens = tokens.select("page_id", url_rules.url_tokens(tokens.url, host, path).alias("tokens"), tokens.page_id.alias("_document"))
    rules = url_rules.mine_rules(url_rules.transactions(url_rules.labelled(tokens, labels))).collect()
    assert ["h:spam"] in [r.tokens for r in rules]
    assert all("h:spam" not in r.tokens or len(r.tokens) == 1 for r in rules)  # the wider ones are redundant
    assert all(r.mined_rule == ("h:spam" if "spam" in r.host else None) for r in got)


@pytest.mark.parametrize("others", [100, 2000])
def test_the_same_evidence_gives_the_same_rule_at_every_size(spark, others):
    urls = [f"http://rare.net/{i}" for i in range(12)] + [f"http://h{i % 7}.org/{i}" for i in range(others)]
    labels = spark.createDataFrame([(i, 0 if i < 12 else 1, None) for i in range(len(urls))], LABELS)
    got = {r.page_id for r in url_rules.judge_urls(pages(spark, *urls), labels).collect() if r.verdict == "block"}
    assert got == set(range(12))


def test_rules_are_relative_to_the_rate_of_all_pages(spark):
    """30 % of a host's pages are bad, where 5 % of all are; 55 % of another's, where 50 % of all are."""
    for host_bad, other_bad, fires in ((30, 5, True), (55, 50, False)):
        urls = [f"http://some.net/{i}" for i in range(100)] + [f"http://h{i % 300}.org/{i}" for i in range(600)]
        bad = [i % 100 < host_bad for i in range(100)] + [i % 100 < other_bad for i in range(600)]
        labels = spark.createDataFrame([(i, int(not b), None) for i, b in enumerate(bad)], LABELS)
        got = [r.verdict == "block" for r in url_rules.judge_urls(pages(spark, *urls), labels, rules=()).collect() if "some" in r.host]
        assert len(got) == 100 and all(got) == any(got) == fires


def test_tokens_that_come_together_are_one_item(spark):
    """Forty path steps that pages share do not make 2^40 itemsets, and a URL of 100,000 characters passes."""
    steps = "/".join(f"step{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40))
    urls = [f"http://bad.net/{steps}/{i}" for i in range(15)] + [f"http://good{i % 9}.net/{i}" for i in range(60)]
    urls.append("http://long.net/" + "/".join(f"{'q' * 20}{i}x" for i in range(4500)))
    labels = spark.createDataFrame([(i, int(i >= 15), None) for i in range(75)], LABELS)
    got = url_rules.judge_urls(pages(spark, *urls), labels).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(15))
    assert {r.mined_rule for r in got if r.verdict == "block"} == {"h:bad"}


def test_mined_rules_equal_the_sql_s_where_they_fire(spark):
    """The small table has no rule; this one has."""
    import duckdb

    c = duckdb.connect()
    for name in ("pages", "labels"):
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.1/{name}.parquet'")
    got = queries.op2_url_filters(spark, "/root/testdata/sf0.1")
    relation = c.sql(url_rules.JUDGE_SQL)
    assert got.columns == relation.columns
    rows = [tuple(r) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, relation.fetchall()))
    assert sum(r[3] is None and r[4] == "block" for r in rows) > 50


def test_repeated_and_empty_pages(spark):
    labels = spark.createDataFrame([(0, 0, 1), (0, 1, 0), (None, 0, 0)], LABELS)
    two = pages(spark, "http://x.com/").union(pages(spark, "http://x.com/"))
    assert url_rules.judge_urls(two, labels).count() == 2
    assert url_rules.judge_urls(pages(spark).limit(0), labels).count() == 0


def brute_measures(text):
    text = text or ""
    space = " \t\n\x0b\x0c\r"
    words = [w for w in "".join(" " if c in space else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if any(c not in space for c in x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(5)}
    repeats = len(covered)
    failed = len(words) < 10 or 100 * repeats > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats, failed


def test_repeats_in_a_very_long_text(spark):
    rows = [(1, " ".join(f"w{i % 7000}" for i in range(12_000))), (2, " ".join(f"v{i}" for i in range(9000)) + " v1 v2 v3 v4 v5")]
    docs = spark.createDataFrame([(*r, None, None, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id: tuple(r)[1:7] for r in quality.judge(docs).collect()} == {d: brute_measures(t) for d, t in rows}


def test_measures_by_brute_force(odd_documents):
    got = sorted(map(str, [(r.doc_id, *tuple(r)[1:7]) for r in quality.judge(odd_documents).collect()]))
    assert got == sorted(map(str, [(d, *brute_measures(t)) for d, t in TEXTS]))


def test_hosts(spark, no_documents):
    good, bad = "one two three four five six seven eight nine ten eleven {}", "x"
    rows = [(i, (bad if i % 10 else good.format(i)), None, "worst", 1) for i in range(200)]
    rows += [(1000 + i, (good.format(i) if i % 20 else bad), None, f"host{i % 5}", 1) for i in range(300)]
    rows += [(5000, good.format("z"), None, "tiny", 1), (5001, bad, None, "small", 1), (5002, good.format("y"), None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert not any(got[i].kept for i in range(200))  # good documents of a failing host go with it
    assert all(got[1000 + i].kept == bool(i % 20) for i in range(300))
    assert got[5000].kept and got[5002].kept and not got[5001].kept
    verdicts = {r._host_key: r for r in quality.host_verdicts(quality.measures(docs)).collect()}
    assert verdicts["worst"].host_failed and not verdicts["small"].host_failed  # one failure is shrunk
    assert verdicts["worst"].failed_few_words == 180 and verdicts["worst"].failed_repeats == verdicts["worst"].failed_symbols == 0
    assert 0 < verdicts["small"].rate_few_words < 1
    assert quality.judge(no_documents).count() == 0


CHATS = "conv_id long, turn long, role string, text string, block long, lines string, mask string"


def test_each_participant_gets_a_view(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", "hé"), (1, 70, "ann", None), (1, 2, "bob", "hé")]
    rows += [(2, None, None, "x"), (3, 0, "system", "alone"), (None, 5, "ann", "y")]
    got = {(r.conv_id, r.perspective, r.block): r for r in chat.rotate(spark.createDataFrame([(*r, 9, "l", "m") for r in rows], CHATS)).collect()}
    assert set(got) == {(1, "ann", 0), (1, "ann", 1), (1, "bob", 0), (1, "bob", 1), (2, "unknown", -1), (None, "ann", 0)}
    bob = got[1, "bob", 0]
    assert bob.n_turns == 4
    assert bob.rendered == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi<|im_end|>\n"
        "<|im_start|>assistant\nhé<|im_end|>\n<|im_start|>assistant\nhé<|im_end|>\n"
    )
    for r in got.values():
        parts = [r.rendered[int(a) - r.starts_at : int(b) - r.starts_at] for a, b in (s.split("-") for s in r["mask"].split(",") if s)]
        assert "".join(parts).count("<|im_end|>") == r.rendered.count("<|im_start|>assistant")
        assert all(p.endswith("<|im_end|>") for p in parts)
    assert got[1, "bob", 1]["mask"] == ""
    assert chat.rotate(spark.createDataFrame([], CHATS)).count() == 0


def test_blocks_put_together_are_the_whole_dialogue(spark):
    rows = [(1, i // 2, ["ann", "bob", "system", None, "cé"][(i + i // 3) % 5], "x" * (i % 9) + "é") for i in range(500)] + [(1, None, "bob", "first")]
    talk = spark.createDataFrame([(*r, 9, "l", "m") for r in rows], CHATS).repartition(5)
    whole = {r.perspective: r for r in chat.rotate(talk, turns=10**6).where("block = 0").collect()}
    first = {r.perspective: r for r in chat.rotate(talk, turns=10**6).where("block = -1").collect()}
    assert set(whole) == {"ann", "bob", "unknown", "cé"}
    blocks = chat.rotate(talk, turns=10).collect()
    for name, r in whole.items():
        mine = sorted((b for b in blocks if b.perspective == name), key=lambda b: b.block)
        assert len(mine) == 26 and "".join(b.rendered for b in mine) == first[name].rendered + r.rendered
        assert [b.starts_at for b in mine] == [sum(len(x.rendered) for x in mine[:k]) for k in range(26)]
        assert ",".join(filter(None, (b["mask"] for b in mine))) == ",".join(filter(None, (first[name]["mask"], r["mask"])))


def test_native_operators_run_no_python(spark, sf_dir):
    from tidelog.llm import decontaminate
    from tidelog.llm.common import table

    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    frames = [
        chat.rotate(table(spark, sf_dir, "conversations")), quality.measures(docs), quality.judge(docs), decontaminate.contamination(docs, bench),
        url_rules.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")),
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))
