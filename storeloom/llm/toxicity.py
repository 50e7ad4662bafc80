"""Toxicity by a bidirectional gated recurrent network over all overlapping windows.

A document's words (ASCII letters lower-cased, punctuation dropped) are cut into
windows of ``WINDOW`` words that begin every ``STRIDE`` words; its score is the
highest probability of its windows, so a short insult in a long text counts as
much as in a short one. Labels are of documents: in training, all windows of a
clean document are clean, and of a toxic one the window that the network rates
highest counts as toxic (multiple-instance learning), after a first pass in
which all windows of its shorter documents do.

Training data are at most ``PER_CLASS`` toxic and ``CLEAN_TIMES`` as many clean
labelled documents (the smallest hashes of their ids), one text an id. Their
whole texts are read: training begins with ``WINDOWS_EACH`` evenly spread windows
of each, and ``ROUNDS`` times the network so far scores all windows of the longer
ones on Spark and adds those that it rates highest, as many a document. So what
comes to the driver doesn't grow with the corpus or with a text. Ids, sources and
languages are no inputs. The network is broadcast (about 2 MB, a fixed size) and
scoring is one map without a shuffle. Defined cases: null and empty text score 0;
repeated rows score alike (an id of several texts is trained on the one with the
least hash); without labels of both classes everything scores 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.common import append, free_name, label_fold, least_hashes, nothing_kept, plain_words, slices, text_digest, texts
from storeloom.llm.recurrent import BiGRU
from storeloom.session import scratch_folder

WINDOW, STRIDE = 64, 48
PER_CLASS, WINDOWS_EACH = 900, 5
PASSES, BATCH, RATE = 6, 96, 0.02
#: How often the network's own choice of windows is added, in even distances over the passes.
ROUNDS = 2
#: Training steps at least; a small sample is passed over more often.
LEAST_STEPS = 300
#: Clean documents in the sample to a toxic one, and how much more a clean window weighs in the loss.
CLEAN_TIMES, CLEAN_WEIGHT = 2, 2.0
HELD_OUT_OF, HELD_OUT = 5, 0
THRESHOLD = 0.5


def window_starts(n_words: int) -> range:
    """Where a text's windows begin; the last one reaches its end."""
    return range(0, max(1, n_words - (WINDOW - STRIDE)), STRIDE) if n_words else range(0)


def sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS,
           held_out_of: int = HELD_OUT_OF, held_out: int = HELD_OUT) -> DataFrame:
    """(id, text, label) of a bounded number of labelled documents of each class, never of the held-out fold; one row an id and label."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where(
        (label_fold(F.col("id"), held_out_of) != held_out) & F.col("label").isin(0, 1))
    picked = None
    for value in (0, 1):
        own = least_hashes(known.where(F.col("label") == value), per_class * (1 if value else CLEAN_TIMES))
        picked = own if picked is None else picked.unionByName(own)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = src.join(F.broadcast(picked), "id")  # at most (1 + CLEAN_TIMES) * per_class ids
    return found.groupBy("id", "label").agg(F.min(F.struct(text_digest(F.col("text")).alias("digest"), "text")).alias("least")).select("id", "least.text", "label")


def _windows_of(labelled: DataFrame, choose) -> list[tuple[int, int, list[bytes]]]:
    """(document, label, words) of the windows whose numbers ``choose(words, starts)`` gives for each document."""
    def cut(batches):
        for part in slices(batches, "text", 2 << 20):
            rows = {"id": [], "label": [], "words": []}
            for i, y, t in zip(part.column("id").to_pylist(), part.column("label").to_pylist(), texts(part, "text"), strict=True):
                words = plain_words(t)
                starts = window_starts(len(words))
                for k in choose(words, starts):
                    rows["id"].append(i)
                    rows["label"].append(y)
                    rows["words"].append(b" ".join(words[starts[k]:starts[k] + WINDOW]))
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("id", pa.int64()), ("label", pa.int32()), ("words", pa.binary())]))
    got = labelled.mapInArrow(cut, "id long, label int, words binary").collect()
    rows = sorted({(r["id"], r["label"], bytes(r["words"])) for r in got})
    return [(i, y, w.split()) for i, y, w in rows]


def training_windows(labelled: DataFrame, windows_each: int = WINDOWS_EACH) -> list[tuple[int, int, list[bytes]]]:
    """At most ``windows_each`` evenly spread windows of each document."""
    return _windows_of(labelled, lambda words, starts: sorted({len(starts) * j // windows_each for j in range(windows_each)}) if starts else [])


def highest_windows(labelled: DataFrame, net: BiGRU, windows_each: int = WINDOWS_EACH) -> list[tuple[int, int, list[bytes]]]:
    """Of each document of more windows than that, the ``windows_each`` which the network rates highest among all."""
    model = labelled.sparkSession.sparkContext.broadcast(cloudpickle.dumps(net))
    loaded: list[BiGRU] = []  # of one task

    def choose(words, starts):
        if len(starts) <= windows_each:
            return []
        if not loaded:
            loaded.append(cloudpickle.loads(model.value))
        p = window_scores(loaded[0], [words])[1]
        return np.argsort(-p, kind="stable")[:windows_each].tolist()
    return _windows_of(labelled, choose)


def _arrays(windows: list[tuple[int, int, list[bytes]]]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Labels, word numbers from 1, the words, and document numbers of the windows."""
    y = np.array([w[1] for w in windows], np.float32)
    words = sorted({w for _, _, own in windows for w in own})
    number = {w: i + 1 for i, w in enumerate(words)}
    ids = np.zeros((len(windows), WINDOW), np.int64)
    for k, (_, _, own) in enumerate(windows):
        ids[k, :len(own)] = [number[w] for w in own]
    return y, ids, words, np.unique([w[0] for w in windows], return_inverse=True)[1]


def train(windows: list[tuple[int, int, list[bytes]]], passes: int = PASSES, batch: int = BATCH, rate: float = RATE, seed: int = 11, more=None, rounds: int = ROUNDS) -> BiGRU | None:
    """The network; None without windows of both classes. ``more(net)`` gives further windows, asked for ``rounds`` times."""
    if len({w[1] for w in windows}) < 2:
        return None
    y, ids, words, doc = _arrays(windows)
    net, rng = BiGRU(), np.random.default_rng(seed)
    in_a_pass = -(-4 * int((y == 1).sum()) // batch)
    passes = max(passes, -(-LEAST_STEPS // max(1, in_a_pass)))
    asked = {passes * (r + 1) // (rounds + 1) for r in range(rounds)} if more else set()
    for k in range(passes):
        if k in asked:
            known = {(i, label, b" ".join(own)) for i, label, own in windows}
            new = [w for w in more(net) if (w[0], w[1], b" ".join(w[2])) not in known]
            if new:
                windows = windows + new
                y, ids, words, doc = _arrays(windows)
        clean = np.flatnonzero(y == 0)
        if k == 0:
            size = np.bincount(doc)[doc]
            toxic = np.flatnonzero((y == 1) & (size <= max(2, int(size[y == 1].min()))))
        else:
            every = np.flatnonzero(y == 1)
            p = score_windows(net, ids[every], words)
            order = np.lexsort((-p, doc[every]))
            first = np.concatenate(([True], np.diff(doc[every][order]) > 0))
            toxic = every[order][first | (p[order] > 0.9)]  # the best of each document, and others that are as clear
        # the pass sees as many clean windows as thrice the toxic ones; the hardest from the third pass on
        count = min(clean.size, 3 * toxic.size)
        if k >= 2:
            p = score_windows(net, ids[clean], words)
            hard = clean[np.argsort(-p, kind="stable")[:count // 2]]
            clean_now = np.concatenate([hard, rng.choice(clean, count - hard.size, replace=False)])
        else:
            clean_now = rng.choice(clean, count, replace=False)
        mixed = rng.permutation(np.concatenate([toxic, clean_now]))
        for at in range(0, mixed.size, batch):
            own = mixed[at:at + batch]
            net.step(ids[own], words, y[own], np.where(y[own] > 0, 1, CLEAN_WEIGHT), rate * (1 - k / passes) + 0.002)
    del net.moments
    return net


def score_windows(net: BiGRU, ids: np.ndarray, words: list[bytes], chunk: int = 4096) -> np.ndarray:
    """Probability of each window."""
    table = net.projected(net.inputs(words)[0])
    return np.concatenate([net.forward(ids[at:at + chunk], table) for at in range(0, ids.shape[0], chunk)] or [np.zeros(0, np.float32)])


def window_scores(net: BiGRU, split: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(text, probability) of all windows of texts given as words, in their order."""
    number: dict[bytes, int] = {}
    flat = np.array([number.setdefault(w, len(number) + 1) for words in split for w in words], np.int64)
    doc, begin, length, base = [], [], [], 0
    for k, words in enumerate(split):
        for s in window_starts(len(words)):
            doc.append(k)
            begin.append(base + s)
            length.append(min(WINDOW, len(words) - s))
        base += len(words)
    at = np.array(begin, np.int64)[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < np.array(length, np.int64)[:, None]
    ids = np.where(inside, flat[np.minimum(at, flat.size - 1)], 0)
    return np.array(doc, np.int64), score_windows(net, ids, list(number))


def score_texts(net: BiGRU | None, rows: list[bytes]) -> np.ndarray:
    """Highest window probability of each text."""
    out = np.zeros(len(rows))
    split = [plain_words(t) for t in rows]
    if net is None or not any(split):
        return out
    doc, p = window_scores(net, split)
    np.maximum.at(out, doc, p)
    return out


def with_score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", **options) -> tuple[DataFrame, str]:
    """``docs`` with one more column, the score, and its name."""
    spark = docs.sparkSession
    path = f"{scratch_folder(spark, 'toxicity')}/sample"
    sample(docs, labels, label, id_col, text_col, **options).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    labelled = spark.read.parquet(path)
    net = train(training_windows(labelled), more=lambda own: highest_windows(labelled, own))
    model = spark.sparkContext.broadcast(cloudpickle.dumps(net))  # by value: workers need not have this package
    name = free_name(docs, "score")

    def run(batches):
        nothing_kept()
        own = cloudpickle.loads(model.value)
        for part in slices(batches, text_col, 2 << 20):
            yield append(part, **{name: pa.array(score_texts(own, texts(part, text_col)), pa.float64())})
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])), name


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out, score = with_score(src, labels.withColumnRenamed(id_col, "doc_id"), **options)
    return out.select("doc_id", (label_fold(F.col("doc_id"), HELD_OUT_OF) == HELD_OUT).alias("held_out"), F.col(score).alias("score"),
                      (F.col(score) >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that score below the threshold, with their own columns."""
    out, score = with_score(docs, labels, id_col, text_col, **options)
    return out.where(F.col(score) < threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
