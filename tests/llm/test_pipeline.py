import hashlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm import decontaminate, ngram_join, suffix_dedup
from tidelog.llm.common import bounded_batches

from .conftest import TEXTS
from .test_duplicates import DOCS, brute_components, family_rows


def test_stages_by_brute_force(spark, sf_dir, pieces):
    """Each stage against SQL or the library, on the rows its predecessor kept."""
    c = duckdb.connect()
    c.sql(f"CREATE VIEW benchmark AS SELECT * FROM '{sf_dir}/benchmark.parquet'")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    def given(df):
        frame = df.toPandas()
        c.register("documents", frame)
        return {int(d): t for d, t in zip(frame.doc_id, frame.text, strict=True)}

    stages = dict(corpus_pipeline.STAGES)
    named = [name for name, _ in corpus_pipeline.STAGES]
    assert named == ["language_id", "ngram_join", "suffix_dedup", "decontamination", "sentencepiece"]
    out = stages["language_id"](spark, docs, sf_dir).cache()
    assert out.columns == docs.columns and out.count() >= 0.99 * docs.count()
    given(out)
    roots = {d for d, _, comp in c.sql(ngram_join.JOIN_SQL).fetchall() if d == comp}
    out = stages["ngram_join"](spark, out, sf_dir).cache()
    assert {r.doc_id for r in out.collect()} == roots
    given(out)
    sums = {d: s for d, _, _, _, s in c.sql(suffix_dedup.DEDUP_SQL).fetchall()}
    out = stages["suffix_dedup"](spark, out, sf_dir).cache()
    rows = out.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    exact = [r for r in rows if hashlib.sha256(r.text.encode()).hexdigest() == sums[r.doc_id]]
    assert len(exact) >= 0.98 * len(rows)  # else a cut went through a character
    given(out)
    dirty = {r[0] for r in c.sql(decontaminate.CONTAMINATION_SQL).fetchall() if r[5]}
    out2 = stages["decontamination"](spark, out, sf_dir).cache()
    assert {r.doc_id for r in out2.collect()} == {r.doc_id for r in rows} - dirty
    texts = given(out2)
    last = {r.doc_id: r for r in stages["sentencepiece"](spark, out2, sf_dir).collect()}
    assert set(last) == set(texts)
    for d, t in texts.items():
        ids = pieces.encode(t)
        assert last[d].n_tokens == len(ids)
        assert last[d].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


    chain = corpus_pipeline.run(spark, sf_dir)
    assert chain.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, chain.collect())) == sorted(map(tuple, last.values()))


def test_odd_and_empty_tables(spark, sf_dir, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            assert out.count() <= len(TEXTS)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_of_five_words_and_four_fifths_go(spark, seed):
    rows = family_rows(seed, 9)
    roots = lambda size, percent: {d for d, (_, root) in brute_components(rows, size, percent).items() if d == root}
    assert roots(5, 80) != roots(4, 85)
    stage = dict(corpus_pipeline.STAGES)["ngram_join"]
    assert {r.doc_id for r in stage(spark, spark.createDataFrame(rows, DOCS), "").collect()} == roots(5, 80)


@pytest.mark.parametrize(("rows", "chars", "most"), [(2000, 10, 250), (40, 1 << 18, 17)])
def test_batches_of_texts_are_small(spark, rows, chars, most):
    """A worker keeps much of what its largest batch took, so a batch has 250 rows and 4 MB at most."""
    names = [f"spark.sql.execution.arrow.{n}" for n in ("maxRecordsPerBatch", "maxBytesPerBatch")]
    before = [spark.conf.get(n) for n in names]
    try:
        for n, x in zip(names, ("10000", "64m"), strict=True):
            spark.conf.set(n, x)
        docs = bounded_batches(spark.range(rows).coalesce(1).select(F.repeat(F.lit("x"), chars).alias("text")))
        sizes = docs.mapInPandas(lambda batches: (pd.DataFrame({"n": [len(b)]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) == rows
        assert max(r.n for r in sizes) <= most
    finally:
        for n, x in zip(names, before, strict=True):
            spark.conf.set(n, x)
