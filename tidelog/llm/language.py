"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Languages and document frequencies are counted over all training rows. The weights are fitted by
follow-the-regularised-leader with elastic-net penalties on a bounded sample of them (``SAMPLE_ROWS``,
with ``LEAST_ROWS`` of each language, so that a rare one is learned at every size of the table),
turned into sparse vectors by the executors, and the scores are calibrated by a temperature on a
part of the sample that is kept aside. Every whole text is then scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import bounded_batches

BUCKETS = 1 << 15
GRAM_SIZES = (1, 2, 3, 4)
SAMPLE_ROWS = 3000  # expected number of rows that the weights are fitted on, shared out by language
LEAST_ROWS = 100  # expected number of rows of a language at least, if it has so many
ASIDE = 5  # every so many rows of the sample calibrate
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNDETERMINED = "und"
PIECE = 1 << 20  # characters that are turned into n-grams at a time

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str | None) -> bool:
    if not text or not _LETTER.search(text):
        return False
    return any(map(str.isalpha, _LETTER.findall(text)))


def gram_counts(text: str) -> np.ndarray:
    """Counts by bucket of the hashed n-grams of a whole text, in lower case, with each ASCII
    character that is no letter read as a space."""
    counts = np.zeros(BUCKETS, np.int64)
    overlap = max(GRAM_SIZES) - 1
    text = text.lower()
    for at in range(0, max(len(text), 1), PIECE):
        part = np.frombuffer(text[at : at + PIECE + overlap].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        part = np.where((part < 128) & ~((part >= 97) & (part <= 122)), np.uint64(32), part)
        last = at + PIECE >= len(text)
        rolled = np.zeros(len(part), np.uint64)
        found = []
        for size in range(1, max(GRAM_SIZES) + 1):
            rolled = rolled[: len(part) - size + 1] * np.uint64(0x100000001B3) + part[size - 1 :] if len(part) >= size else rolled[:0]
            if size in GRAM_SIZES and len(rolled):
                own = rolled if last else rolled[:PIECE]
                found.append(((own + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(49)).astype(np.int64))
        if found:
            counts += np.bincount(np.concatenate(found), minlength=BUCKETS)
    return counts


@dataclass
class LanguageModel:
    """idf by bucket, weights by bucket and language, a bias by language, and the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, text: str) -> np.ndarray:
        counts = gram_counts(text)
        at = np.nonzero(counts)[0]
        x = _vector(counts[at], self.idf[at])
        return x @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        p = _softmax(self.logits(text) / self.temperature)
        best = int(np.argmax(p))
        return self.languages[best], float(p[best])


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length 1, with logarithmic term frequencies."""
    x = (1.0 + np.log(counts)) * idf
    norm = np.sqrt(x @ x)
    return x / norm if norm else x


def _softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(training: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many training texts each bucket occurs, and how many texts there are. Each task adds up
    its own rows, so that at most BUCKETS rows a task are shuffled and BUCKETS reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, rows = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b["_text"]:
                found += gram_counts(t) > 0
                rows += 1
        at = np.nonzero(found)[0]
        yield pd.DataFrame({"bucket": np.r_[at, -1], "n": np.r_[found[at], rows]})

    parts = training.select(F.col(text).alias("_text")).mapInPandas(run, "bucket long, n long")
    sums = {r["bucket"]: r["n"] for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    rows = sums.pop(-1, 0)
    df = np.zeros(BUCKETS)
    for b, n in sums.items():
        df[b] = n
    return df, rows


def thresholds(counts: dict[str, int]) -> dict[str, int]:
    """By language, the 63-bit hash up to which a row is drawn. A language's expected share of the
    sample is its share of the rows, but LEAST_ROWS at least; all rows where it has fewer."""
    rows = sum(counts.values())
    wanted = {x: max(SAMPLE_ROWS * n / rows, LEAST_ROWS) for x, n in counts.items()}
    return {x: (1 << 63) - 1 if wanted[x] >= n else int(wanted[x] / n * (1 << 63)) for x, n in counts.items()}


def language_counts(training: DataFrame, label: str) -> dict[str, int]:
    """Training rows by language; languages are taken to be few."""
    return {r[0]: r[1] for r in training.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def sample_vectors(training: DataFrame, counts: dict[str, int], text: str, label: str, key: str) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Label, buckets and counts of a sample of about SAMPLE_ROWS rows, chosen by a hash of the key
    and in the order of another, so that it does not depend on the partitions."""
    limits = training.sparkSession.createDataFrame(list(thresholds(counts).items()), "_name string, _limit long")
    drawn = training.join(F.broadcast(limits), F.col(label) == F.col("_name"))  # a row for each language
    drawn = drawn.where(F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit("sample")), 1) <= F.col("_limit"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for order, name, t in zip(b["_order"], b["_label"], b["_text"], strict=True):
                counts = gram_counts(t)
                at = np.nonzero(counts)[0]
                out.append((order, name, at.astype(np.uint16).tobytes(), counts[at].clip(max=2**31 - 1).astype(np.int32).tobytes()))
            yield pd.DataFrame(out, columns=["o", "label", "at", "counts"])

    chosen = drawn.select(F.xxhash64(F.col(key), F.lit("order")).alias("_order"), F.col(label).alias("_label"), F.col(text).alias("_text"))
    vectors = chosen.mapInPandas(run, "o long, label string, at binary, counts binary").collect()
    vectors.sort(key=lambda r: (r["o"], r["label"], bytes(r["at"])))
    return [(r["label"], np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["counts"], np.int32)) for r in vectors]


def follow_leader(vectors: list, languages: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with L1 and L2 penalties: weights and unpenalised biases."""
    c, number = len(languages), {x: i for i, x in enumerate(languages)}
    z, n = np.zeros((BUCKETS, c)), np.zeros((BUCKETS, c))
    bz, bn = np.zeros(c), np.zeros(c)

    def solve(z, n, l1, l2):
        return np.where(np.abs(z) > l1, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2), 0.0)

    for _ in range(EPOCHS):
        for label, at, counts in vectors:
            x = _vector(counts, idf[at])
            zi, ni = z[at], n[at]
            w, b = solve(zi, ni, L1, L2), solve(bz, bn, 0.0, 0.0)
            error = _softmax(x @ w + b)
            error[number[label]] -= 1.0
            g = x[:, None] * error
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
            bz += error - (np.sqrt(bn + error * error) - np.sqrt(bn)) / ALPHA * b
            bn += error * error
    return solve(z, n, L1, L2), solve(bz, bn, 0.0, 0.0)


def fit_temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature in [0.1, 10] of least log loss (a grid in logarithmic steps); 1 without rows."""
    if not len(truth):
        return 1.0
    grid = np.geomspace(0.1, 10, 81)
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def held_out(key: Column) -> Column:
    """Whether a row is kept from training; a row without a key is."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> LanguageModel:
    """Learn from the rows that are not held out and have a label and a text. Without such rows the
    model knows no language and predicts ``und``."""
    usable = F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key))
    training = bounded_batches(documents).where(usable).select(F.col(key).alias(key), F.col(text).alias(text), F.col(label).alias(label))
    df, rows = document_frequencies(training, text)
    idf = np.log((1.0 + rows) / (1.0 + df)) + 1.0
    counts = language_counts(training, label)
    vectors = sample_vectors(training, counts, text, label, key) if counts else []
    languages = sorted({v[0] for v in vectors})
    if not languages:
        return LanguageModel([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    fit = [v for i, v in enumerate(vectors) if i % ASIDE] or vectors
    aside = [v for i, v in enumerate(vectors) if i % ASIDE == 0]
    weights, bias = follow_leader(fit, languages, idf)
    logits = np.array([_vector(c, idf[at]) @ weights[at] + bias for _, at, c in aside])
    temperature = fit_temperature(logits, np.array([languages.index(v[0]) for v in aside]))
    return LanguageModel(languages, idf, weights, bias, temperature)


def with_language(documents: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` (a learned language, or ``und`` for a text that is null or has no letter)
    and ``score`` (its calibrated probability; 0 for ``und``), computed from the text alone."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in texts:
            yield pd.DataFrame([known.predict(t) for t in batch], columns=["lang_pred", "score"])

    scored = bounded_batches(documents).withColumn("_predicted", predict(F.col(text)))
    return scored.withColumn("lang_pred", F.col("_predicted.lang_pred")).withColumn("score", F.col("_predicted.score")).drop("_predicted")


def identify(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """Per document: key, held_out, lang_pred, score. Repeated rows give a row each."""
    model = train(documents, key, text, label)
    rows = documents.select(F.col(key).alias(key), held_out(F.col(key)).alias("held_out"), F.col(text).alias("_text"))
    return with_language(rows, model, "_text").select(key, "held_out", "lang_pred", "score")
