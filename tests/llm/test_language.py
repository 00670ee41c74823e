import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import language

from .conftest import LONG, PROSE, TEXTS


def test_held_out_rows_are_predicted_well(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in unseen]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).repartition(3)
    a, b = (sorted(tuple(r) for r in language.identify(d).collect()) for d in (docs, changed))
    assert a == b


def test_counts_do_not_depend_on_the_pieces(monkeypatch):
    text = PROSE + "é中 x" + PROSE
    whole = language.gram_counts(text)
    assert whole.sum() == sum(len(text) - n + 1 for n in language.GRAM_SIZES)
    monkeypatch.setattr(language, "PIECE", 17)
    assert (language.gram_counts(text) == whole).all()
    assert language.gram_counts("").sum() == 0 and language.gram_counts("ab").sum() == 3


def test_letters():
    for c in map(chr, [*range(0x3000), 0x4E2D, 0x1F600, 0x1D400]):
        assert language.has_letter(f"1 {c}_") == c.isalpha(), hex(ord(c))
    assert not language.has_letter(None) and not language.has_letter("")


def test_penalties_make_weights_sparse_and_the_temperature_calibrates(monkeypatch):
    monkeypatch.setattr(language, "L1", 1.5)
    r = np.random.default_rng(0)
    vectors = []
    for i in range(200):
        label = "ab"[i % 2]
        at = np.unique(np.r_[i % 2, r.integers(2, 400, 20)])
        vectors.append((label, at, np.ones(len(at), np.int32)))
    weights, bias = language.follow_leader(vectors, ["a", "b"], np.ones(language.BUCKETS))
    assert weights[0, 0] > 0 > weights[1, 0] and (weights[400:] == 0).all()
    assert (weights[2:400] == 0).mean() > 0.2
    logits, truth = r.normal(size=(500, 2)), r.integers(0, 2, 500)
    logits[np.arange(500), truth] += 1.0
    assert language.fit_temperature(logits * 8, truth) > language.fit_temperature(logits, truth)
    assert language.fit_temperature(np.empty((0, 2)), np.empty(0, int)) == 1.0


def test_odd_and_empty_tables(odd_documents, no_documents):
    got = {(r.doc_id, r.lang_pred) for r in language.identify(odd_documents).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (10, "und")} <= got
    assert all(p in ("en", "fr", "und") for _, p in got)
    assert language.identify(odd_documents).count() == len(TEXTS)
    assert language.identify(no_documents).count() == 0
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    assert len(LONG) > 200_000


def test_sampling_works_for_any_number_of_rows():
    limits = language.thresholds({"en": 10**10, "fr": 4 * 10**9, "rare": 150, "few": 3})
    share = {x: n / 2**63 for x, n in limits.items()}
    assert abs(share["en"] * 10**10 - 3000 * 10 / 14) < 1 and abs(share["fr"] * 4 * 10**9 - 3000 * 4 / 14) < 1
    assert abs(share["rare"] * 150 - language.LEAST_ROWS) < 1 and limits["few"] == 2**63 - 1


def test_a_rare_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_ROWS", 60)
    monkeypatch.setattr(language, "LEAST_ROWS", 20)
    rows = [(i, f"the cat and the dog number {i} went home", "en") for i in range(3000)]
    rows += [(5000 + i, f"der hund und die katze nummer {i} ging heim", "de") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model.languages == ["de", "en"]
    assert model.predict("die katze und der hund")[0] == "de" and model.predict("the dog and the cat")[0] == "en"


def plain_counts(text):
    """Counts by bucket, one n-gram at a time."""
    out, mask = {}, 2**64 - 1
    text = "".join(c if ord(c) >= 128 or "a" <= c <= "z" else " " for c in text.lower())
    for size in language.GRAM_SIZES:
        for i in range(len(text) - size + 1):
            h = 0
            for c in text[i : i + size]:
                h = (h * 0x100000001B3 + ord(c)) & mask
            b = ((h + size) * 0x9E3779B97F4A7C15 & mask) >> 49
            out[b] = out.get(b, 0) + 1
    return out


def plain_vector(counts, idf):
    x = {b: (1 + math.log(n)) * idf(b) for b, n in counts.items()}
    norm = math.sqrt(sum(v * v for v in x.values()))
    return {b: v / norm for b, v in x.items()}


def test_training_by_a_plain_implementation(spark):
    """TF-IDF, the sample's order, FTRL with elastic net and the temperature, in plain Python."""
    words = {"en": "the cat sat on a mat with hats", "fr": "le chat est sur un tapis avec été", "es": "el gato está en la mesa niño"}
    rows = [(i, " ".join(w for k, w in enumerate(t.split()) if (i >> k) % 2), x) for i in range(40, 130) for x, t in [list(words.items())[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    keyed = docs.select("doc_id", F.xxhash64("doc_id", F.lit("order")).alias("o")).collect()
    order = {r.doc_id: r.o for r in keyed}
    train = sorted((r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1), key=lambda r: order[r[0]])
    counts = [plain_counts(t) for _, t, _ in train]
    df = {}
    for c in counts:
        for b in c:
            df[b] = df.get(b, 0) + 1
    idf = lambda b: math.log((1 + len(train)) / (1 + df.get(b, 0))) + 1
    names = ["en", "es", "fr"]
    assert model.languages == names
    z, n, bz, bn = {}, {}, [0.0] * 3, [0.0] * 3

    def weight(z, n, l1, l2):
        return 0.0 if abs(z) <= l1 else -(z - math.copysign(l1, z)) / ((language.BETA + math.sqrt(n)) / language.ALPHA + l2)

    def scores(x):
        return [sum(v * weight(z.get((b, k), 0.0), n.get((b, k), 0.0), language.L1, language.L2) for b, v in x.items()) + weight(bz[k], bn[k], 0, 0) for k in range(3)]

    fit = [(plain_vector(c, idf), names.index(r[2])) for i, (c, r) in enumerate(zip(counts, train, strict=True)) if i % language.ASIDE]
    for _ in range(language.EPOCHS):
        for x, truth in fit:
            s = scores(x)
            total = sum(math.exp(v) for v in s)
            for k in range(3):
                error = math.exp(s[k]) / total - (k == truth)
                for b, v in x.items():
                    g, was = v * error, n.get((b, k), 0.0)
                    w = weight(z.get((b, k), 0.0), was, language.L1, language.L2)
                    z[b, k] = z.get((b, k), 0.0) + g - (math.sqrt(was + g * g) - math.sqrt(was)) / language.ALPHA * w
                    n[b, k] = was + g * g
                w = weight(bz[k], bn[k], 0, 0)
                bz[k] += error - (math.sqrt(bn[k] + error * error) - math.sqrt(bn[k])) / language.ALPHA * w
                bn[k] += error * error
    for (b, k), v in z.items():
        assert abs(model.weights[b, k] - weight(v, n[b, k], language.L1, language.L2)) < 1e-9
    aside = [(scores(plain_vector(c, idf)), names.index(r[2])) for i, (c, r) in enumerate(zip(counts, train, strict=True)) if i % language.ASIDE == 0]
    loss = lambda t: -sum(s[k] / t - math.log(sum(math.exp(v / t) for v in s)) for s, k in aside)
    assert abs(model.temperature - min(np.geomspace(0.1, 10, 81), key=loss)) < 1e-9
    text = "the cat est sur la mesa"
    s = [v / model.temperature for v in scores(plain_vector(plain_counts(text), idf))]
    best = max(range(3), key=s.__getitem__)
    assert model.predict(text)[0] == names[best] and abs(model.predict(text)[1] - math.exp(s[best]) / sum(map(math.exp, s))) < 1e-9
