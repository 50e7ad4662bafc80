"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text is counted over hashed terms: character trigrams, trigrams of character
shapes (capital, small, digit, space or the sign itself) and terms for what
repeats in it (a word after itself, a line again, words of a 5-word window
again). Root frequencies, weighted by inverse document frequency and brought to
length one, are reduced to ``DIMENSIONS`` latent dimensions by a randomized
singular value decomposition of the labelled sample. Every document's vector
meets all labelled vectors in exact blocked cosine products; the labels of the
``NEIGHBOURS`` nearest vote, each weighted by a power of its similarity.

The labelled sample is the ``SAMPLE`` labelled documents outside the held-out
fold with the smallest hashes of their ids; its bound doesn't grow with the
corpus. The projection and the labelled vectors (a fixed size, about 1.5 MB)
are broadcast; scoring is one map without a shuffle. Ties among neighbours go
to the earlier one in the sample's order. Defined cases: null, empty and blank
text score 0; repeated rows score alike; without any label all score 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.common import append, free_name, joined, label_fold, least_hashes, mix, nothing_kept, slices, texts
from storeloom.llm.quality_rules import repeated_words

SAMPLE, DIMENSIONS, NEIGHBOURS, POWER = 4000, 48, 24, 4
TRIGRAMS, SHAPES, REPEATS = 1024, 1024, 16
TERMS = TRIGRAMS + SHAPES + REPEATS
HELD_OUT_OF, HELD_OUT = 4, 2
THRESHOLD = 0.7

_SHAPE = np.array([65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)], np.uint64)
_SMALL = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64)


def _trigrams(codes: np.ndarray, rows: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Counts of hashed trigrams per text."""
    key = codes[:-2] | codes[1:-1] << np.uint64(8) | codes[2:] << np.uint64(16)
    bucket = (mix(key) >> np.uint64(32)).astype(np.int64) % buckets
    same = rows[2:] == rows[:-2]
    return np.bincount(rows[:-2][same] * buckets + bucket[same], minlength=n * buckets).reshape(n, buckets)


def term_vectors(rows: list[bytes]) -> np.ndarray:
    """Root relative frequencies of the terms of each text; zeros for a text without words."""
    n = len(rows)
    data, starts = joined(rows, b"\n")
    flat = np.frombuffer(data, np.uint8)
    row = np.repeat(np.arange(n), np.diff(starts))
    out = np.zeros((n, TERMS), np.float32)
    if flat.size >= 3:
        out[:, :TRIGRAMS] = _trigrams(_SMALL[flat], row, n, TRIGRAMS)
        out[:, TRIGRAMS:TRIGRAMS + SHAPES] = _trigrams(_SHAPE[flat], row, n, SHAPES)
    size = np.maximum(np.diff(starts), 1)[:, None]
    out /= size
    numbers: dict[bytes, int] = {}
    split = [t.split() for t in rows]
    words = np.array([len(w) for w in split], np.int64)
    ids = np.array([numbers.setdefault(w, len(numbers)) for own in split for w in own], np.int64)
    per_word = np.maximum(words, 1)
    place = np.repeat(np.arange(n), words)
    stutter = np.bincount(place[1:][(ids[1:] == ids[:-1]) & (place[1:] == place[:-1])], minlength=n) / per_word
    again = repeated_words(ids, words) / per_word
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in rows]
    dup = np.array([1 - len(set(x)) / len(x) if x else 0 for x in lines])
    base = TRIGRAMS + SHAPES
    for k, share in enumerate((stutter, again, dup)):
        for level, least in enumerate((0.05, 0.15, 0.3, 0.5)):  # a term for each level that the share reaches
            out[:, base + 4 * k + level] = 0.02 * (share > least)
    for level, most in enumerate((5, 10, 15, 20)):
        out[:, base + 12 + level] = 0.02 * (words < most)
    out[words == 0] = 0
    return np.sqrt(out)


class Votes:
    """Projection and labelled vectors; ``score`` gives the weighted share of label 1."""

    def __init__(self, terms: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS, seed: int = 3):
        used = (terms > 0).sum(axis=0)
        self.idf = np.log((1 + len(terms)) / (1 + used)).astype(np.float32) + np.float32(0.5)
        x = self._weighted(terms)
        rng = np.random.default_rng(seed)
        q = x @ rng.normal(size=(x.shape[1], dimensions + 16)).astype(np.float32)
        for _ in range(4):  # subspace iteration
            q = np.linalg.qr(x @ (x.T @ np.linalg.qr(q)[0]))[0]
        _, _, vt = np.linalg.svd(q.T @ x, full_matrices=False)
        self.axes = np.ascontiguousarray(vt[:dimensions].T)
        self.vectors, self.labels = self.project(terms), labels.astype(np.float32)

    def _weighted(self, terms: np.ndarray) -> np.ndarray:
        x = terms * self.idf
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def project(self, terms: np.ndarray) -> np.ndarray:
        v = self._weighted(terms) @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def score(self, terms: np.ndarray, block: int = 512, neighbours: int = NEIGHBOURS) -> np.ndarray:
        out = np.zeros(len(terms))
        k = min(neighbours, len(self.labels))
        for at in range(0, len(terms), block):
            cosine = self.project(terms[at:at + block]) @ self.vectors.T
            # the k-th largest of each row; of equal ones at that value the earlier count
            least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1:k]
            over = cosine > least
            ties = cosine == least
            chosen = over | ties & (np.cumsum(ties, axis=1) <= k - over.sum(axis=1, keepdims=True))
            weight = np.where(chosen, np.maximum(cosine, 0), 0).astype(np.float64) ** POWER
            total = weight.sum(axis=1)
            out[at:at + block] = np.where(total > 0, weight @ self.labels / np.maximum(total, 1e-300), 0)
        out[~terms.any(axis=1)] = 0
        return np.clip(out, 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Term vectors and labels of at most ``rows`` labelled ids outside the held-out fold."""
    known = least_hashes(labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where(
        (label_fold(F.col("id"), HELD_OUT_OF) != HELD_OUT) & F.col("label").isin(0, 1)), rows)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def vectors(batches):
        for part in slices(batches, "text"):
            terms = term_vectors(texts(part, "text")).astype(np.float16)
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("label"), pa.array([v.tobytes() for v in terms], pa.binary())], names=["id", "label", "terms"])
    # an id may stand in several documents: one row an id and label, the least, keeps the bound
    got = (src.join(F.broadcast(known), "id").select("id", "label", "text").mapInArrow(vectors, "id long, label int, terms binary")
           .groupBy("id").agg(F.min(F.struct("terms", "label")).alias("row")).select("id", "row.label", "row.terms").collect())
    got.sort(key=lambda r: r["id"])
    if not got:
        return np.zeros((0, TERMS), np.float32), np.zeros(0)
    return np.stack([np.frombuffer(bytes(r["terms"]), np.float16) for r in got]).astype(np.float32), np.array([r["label"] for r in got])


def with_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", rows: int = SAMPLE) -> tuple[DataFrame, str]:
    """``docs`` with one more column, the score, and its name."""
    terms, marks = labelled_sample(docs, labels, label, id_col, text_col, rows)
    model = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Votes(terms, marks) if len(marks) else None))  # by value: workers need not have this package
    name = free_name(docs, "score")

    def run(batches):
        nothing_kept()
        votes = cloudpickle.loads(model.value)
        for part in slices(batches, text_col):
            own = texts(part, text_col)
            score = votes.score(term_vectors(own)) if votes else np.zeros(len(own))
            yield append(part, **{name: pa.array(score, pa.float64())})
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])), name


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out, score = with_score(src, labels.withColumnRenamed(id_col, "doc_id"), **options)
    return out.select("doc_id", (label_fold(F.col("doc_id"), HELD_OUT_OF) == HELD_OUT).alias("held_out"), F.col(score).alias("score"),
                      (F.col(score) >= threshold).cast("int").alias("predicted"))
