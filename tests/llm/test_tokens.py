import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import sentencepiece_codec, token_counts
from tidelog.llm.piece_bpe import default_model, vocabulary
from tidelog.llm.sentencepiece_codec import MergeRounds, codec
from tidelog.llm.token_counts import CountTransducer, transducer

from .conftest import TEXTS

ANY = st.text(st.characters(exclude_categories=["Cs"]), max_size=60)
FEW = st.text(st.sampled_from(" ▁aethsn\né中\x00."), max_size=120)


@settings(max_examples=300, deadline=None)
@given(st.one_of(ANY, FEW))
def test_encoding_counting_and_decoding_are_the_library_s(pieces, text):
    expected = pieces.encode(text)
    coder = codec(default_model())
    assert coder.encode(text).tolist() == expected
    assert coder.decode(expected) == pieces.decode(expected)
    assert transducer(default_model()).count_many([text]) == [len(expected)]


@pytest.mark.parametrize("text", ["a" * 3000, " " * 333 + "x", "ab" * 700 + "\n" * 40, "the" * 500, "▁" * 65, "é" * 200 + " " * 17 + "é"])
def test_long_runs(pieces, text):
    expected = pieces.encode(text)
    assert codec(default_model()).encode(text).tolist() == expected
    assert transducer(default_model()).count_many([text]) == [len(expected)]


RUNS = [" internationalisation" * 3 + "hesthethesthe" * 9, "a" * 333, "aab" * 200 + "é" * 70, "中文字" * 60 + "😀" * 9 + "the" * 90]


@pytest.mark.parametrize("text", RUNS)
@pytest.mark.parametrize("size", [1, 3, 7, 50])
def test_maps_compose_whatever_the_chunks(pieces, text, size):
    """The scan gives the count of every prefix that ends with a chunk."""
    machine = CountTransducer(vocabulary(default_model()))
    text = text if text[0] == " " else " " + text
    chunks = [text[i : i + size] for i in range(0, len(text), size)]
    got = machine.scan(chunks).tolist()
    ends = [min(len(text), (i + 1) * size) for i in range(len(chunks))]
    assert got == [len(pieces.encode(text[1:e])) if e > 1 else 1 for e in ends]


def test_maps_hold_for_every_entry_state(pieces):
    """A map evaluated at a state agrees with the machine started there, and leads to known states."""
    machine = CountTransducer(vocabulary(default_model()))
    chunks = ["hesthe", "sthehe", "aaaaaa", "aaaaab", "internat", "ionalis"]
    to, adds = machine.state_maps(chunks)
    exits, counts = machine.run(["".join(chunks)], np.zeros(1, np.int32))
    at, total = 0, 0
    for i in range(len(chunks)):
        at, total = to[i, at], total + adds[i, at]
    assert total == counts[0] == machine.scan(chunks)[-1]


def test_a_vocabulary_beyond_the_rule_is_counted_by_merging(pieces, monkeypatch):
    machine = CountTransducer(vocabulary(default_model()))

    def fail(*_):
        raise token_counts.NotFinite("no")

    monkeypatch.setattr(machine, "_make", fail)
    text = "the cat 中\x00 " + "ab" * 90
    assert machine.count_many([text]) == [len(pieces.encode(text))]


def test_a_worker_remembers_a_bounded_number_of_segments(pieces):
    """Texts whose words never come again: what is remembered does not grow with them."""
    coder = MergeRounds(vocabulary(default_model()))
    most, texts = 0, [" ".join(f"{i:05x}" for i in range(k, k + 5000)) for k in range(0, 240_000, 5000)]
    for text, ids in zip(texts, coder.encode_many(texts), strict=True):
        most = max(most, len(coder.memory))
        assert ids.tolist() == pieces.encode(text)
    assert 50_000 < most <= 180_000


def test_queries_over_a_whole_table(spark, sf_dir, pieces):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = {d: pieces.encode(t or "") for d, t in texts.items()}
    for r in token_counts.count_tokens(docs, limit=100).collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 100)
    for r in sentencepiece_codec.digests(docs).collect():
        assert r.n_tokens == len(ids[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(pieces.decode(ids[r.doc_id]).encode()).hexdigest()


def test_odd_and_empty_tables(spark, odd_documents, no_documents, pieces):
    expected = sorted((str(d), len(pieces.encode(t or ""))) for d, t in TEXTS)
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.count_tokens(odd_documents).collect()) == expected
    assert sorted((str(r.doc_id), r.n_tokens) for r in sentencepiece_codec.digests(odd_documents).collect()) == expected
    assert token_counts.count_tokens(no_documents).count() == sentencepiece_codec.digests(no_documents).count() == 0
    both = sentencepiece_codec.decode_column(sentencepiece_codec.encode_column(odd_documents))
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in both.collect())
    assert set(odd_documents.columns) < set(both.columns)
