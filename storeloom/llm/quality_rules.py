"""Quality rules as a short-circuit cascade.

Every document gets its base counts. Then the rules run as a cascade: a rule
sees only the documents of a slice that no earlier rule has rejected. The order
is chosen before, from a sample: each rule's cost (seconds) and the rows it
rejects are measured on the same rows, and the rule with the most rejections
per second among the rows still left goes next. The verdict doesn't depend on
the order, so timing can't change a result.

Words are ``[^\\x20\\x09-\\x0D]+``. Base counts: ``word_chars`` (code points in
words), ``n_symbols`` (characters of ``#*$%&|<>``), ``n_dup_lines`` (lines with a
word, split at ``\\n``, equal to an earlier line), ``n_repeat_words`` (words in
5-word windows that occur twice or more in the text).

Scale: one map over the documents, no shuffle of texts; the sample is about
``sample_rows`` random rows of all documents, measured by one task that returns
one row a rule. Defined cases: null and empty text have no words and fail the base
rule; repeated rows give equal results; other columns pass through.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.common import append, free_name, joined, mix, per_row, slices, texts

SAMPLE_ROWS = 512

# The limits of the rules. A document is rejected beyond them.
MIN_WORDS = 10            # words
MAX_REPEAT_PCT = 20       # % of words in repeated 5-word windows
MAX_SYMBOL_PCT = 10       # symbols per 100 words
MEAN_WORD = (3, 12)       # code points per word
MAX_DUP_LINE_PCT = 50     # % of lines with a word
MAX_STUTTER_PCT = 25      # % of words equal to the word before
MIN_LETTER_WORD_PCT = 70  # % of words with an ASCII letter or a code point from U+0080
MAX_CAPITALS_PCT = 30     # capital letters per 100 ASCII letters
MAX_ELLIPSIS_PCT = 30     # % of lines with a word that end in "..."
MAX_BULLET_PCT = 90       # % of lines with a word that begin with "-" or "*"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SPACE, _SYMBOL = _table(b" \t\n\x0b\x0c\r"), _table(b"#*$%&|<>")
_UPPER, _LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_LETTER = _UPPER | _LOWER | _table(bytes(range(128, 256)))


class Slice:
    """Texts of some rows, with counts that several rules need; ``take`` keeps some rows."""

    def __init__(self, rows: list[bytes], base: dict[str, np.ndarray] | None = None):
        self.rows = rows
        self._buffer = None
        self.base = base if base is not None else self._base()

    @property
    def buffer(self) -> tuple[np.ndarray, np.ndarray]:
        if self._buffer is None:
            data, starts = joined(self.rows, b"\n")
            self._buffer = np.frombuffer(data, np.uint8), starts
        return self._buffer

    def take(self, keep: np.ndarray) -> Slice:
        if keep.all():
            return self
        return Slice([t for t, k in zip(self.rows, keep.tolist(), strict=True) if k], {n: v[keep] for n, v in self.base.items()})

    def count(self, table: np.ndarray) -> np.ndarray:
        flat, starts = self.buffer
        return per_row(table[flat], starts)

    def lines(self) -> list[list[bytes]]:
        """Lines with a word."""
        return [[x for x in t.split(b"\n") if x.strip()] for t in self.rows]

    def _base(self) -> dict[str, np.ndarray]:
        flat, starts = self.buffer
        space = _SPACE[flat]
        out = {"word_chars": per_row(~space & ((flat & 0xC0) != 0x80), starts), "n_symbols": per_row(_SYMBOL[flat], starts)}
        numbers: dict[bytes, int] = {}
        ids, sizes = [], []
        for t in self.rows:
            words = t.split()
            sizes.append(len(words))
            ids += [numbers.setdefault(w, len(numbers)) for w in words]
        n = np.array(sizes, np.int64)
        out["n_words"] = n
        flat_ids, row = np.array(ids, np.int64), np.repeat(np.arange(n.size), n)
        out["n_repeat_words"] = repeated_words(flat_ids, n)
        out["n_stutter"] = np.bincount(row[1:][(flat_ids[1:] == flat_ids[:-1]) & (row[1:] == row[:-1])], minlength=n.size)
        dups, with_word = [], []
        for lines in self.lines():
            with_word.append(len(lines))
            dups.append(len(lines) - len(set(lines)))
        out["n_dup_lines"], out["n_lines"] = np.array(dups, np.int64), np.array(with_word, np.int64)
        return out


def repeated_words(ids: np.ndarray, sizes: np.ndarray, window: int = 5) -> np.ndarray:
    """Per text (``sizes`` words each): words in windows that occur twice or more in it."""
    rows = np.repeat(np.arange(sizes.size), sizes)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    n = ids.size - window + 1
    if n <= 0:
        return np.zeros(sizes.size, np.int64)
    at = np.flatnonzero(rows[:n] == rows[window - 1:])
    key = mix(rows[at].astype(np.uint64) + np.uint64(1))
    for j in range(window):
        key = mix(key ^ ids[at + j].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    near = np.zeros(at.size, bool)
    near[1:] |= same
    near[:-1] |= same
    at = at[order][near]  # equal hashes: now compare the windows themselves
    if not at.size:
        return np.zeros(sizes.size, np.int64)
    full = np.stack([rows[at], *(ids[at + j] for j in range(window))])
    order = np.lexsort(full)
    same = (full[:, order][:, 1:] == full[:, order][:, :-1]).all(axis=0)
    twice = np.zeros(at.size, bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(ids.size + 1, np.int64)
    hit = at[order][twice]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + window, -1)
    return per_row(np.cumsum(edge[:-1]) > 0, starts)


def base_failed(b: dict[str, np.ndarray]) -> np.ndarray:
    return (b["n_words"] < MIN_WORDS) | (100 * b["n_repeat_words"] > MAX_REPEAT_PCT * b["n_words"])


def _word_length(s: Slice) -> np.ndarray:
    n, c = s.base["n_words"], s.base["word_chars"]
    return (c < MEAN_WORD[0] * n) | (c > MEAN_WORD[1] * n)


def _letterless(s: Slice) -> np.ndarray:
    flat, starts = s.buffer
    space = _SPACE[flat]
    first = ~space & np.concatenate(([True], space[:-1]))
    begins = np.flatnonzero(first)
    lettered = np.zeros(flat.size, bool)
    if begins.size:
        lettered[begins] = np.maximum.reduceat(_LETTER[flat], begins)
    return 100 * per_row(lettered, starts) < MIN_LETTER_WORD_PCT * s.base["n_words"]


def _ellipsis(s: Slice) -> np.ndarray:
    n = np.array([sum(x.rstrip().endswith(b"...") for x in lines) for lines in s.lines()], np.int64)
    return 100 * n > MAX_ELLIPSIS_PCT * s.base["n_lines"]


def _bullets(s: Slice) -> np.ndarray:
    n = np.array([sum(x.lstrip()[:1] in (b"-", b"*") for x in lines) for lines in s.lines()], np.int64)
    return 100 * n > MAX_BULLET_PCT * s.base["n_lines"]


#: Each rule gives the rows it rejects.
RULES: dict[str, Callable[[Slice], np.ndarray]] = {
    "symbols": lambda s: 100 * s.base["n_symbols"] > MAX_SYMBOL_PCT * s.base["n_words"],
    "word_length": _word_length,
    "dup_lines": lambda s: 100 * s.base["n_dup_lines"] > MAX_DUP_LINE_PCT * s.base["n_lines"],
    "stutter": lambda s: 100 * s.base["n_stutter"] > MAX_STUTTER_PCT * s.base["n_words"],
    "letterless": _letterless,
    "capitals": lambda s: 100 * s.count(_UPPER) > MAX_CAPITALS_PCT * s.count(_UPPER | _LOWER),
    "ellipsis": _ellipsis,
    "bullets": _bullets,
}


def measure(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Per rule: name, seconds over the sample, and the sample rows it rejects (as 0/1 bytes)."""
    src = docs.select(F.col(text_col).cast("string").alias("text"))
    n = max(1, src.count())  # from the files' footers
    sample = src.sample(min(1.0, sample_rows / n), seed=1).limit(4 * sample_rows).coalesce(1)

    def run(batches):
        seconds, rejected = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, b"")
        for part in slices(batches, "text"):
            whole = Slice(texts(part, "text"))
            whole = whole.take(~base_failed(whole.base))
            for name, rule in RULES.items():
                own = Slice(whole.rows, whole.base)  # no buffer that an earlier rule has made
                began = time.perf_counter()
                rejected[name] += rule(own).astype(np.uint8).tobytes()
                seconds[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": list(RULES), "seconds": list(seconds.values()), "rejected": list(rejected.values())})
    return [r.asDict() for r in sample.mapInArrow(run, "rule string, seconds double, rejected binary").collect()]


def plan(measured: list[dict]) -> list[str]:
    """Rules by rejections per second among the rows left, best first; ties by cost, then name."""
    left = {r["rule"]: (max(r["seconds"], 1e-9), np.frombuffer(bytes(r["rejected"]), np.uint8).astype(bool)) for r in measured}
    order: list[str] = []
    alive = None
    while left:
        rate = {k: (-(v & alive if alive is not None else v).sum() / s, s, k) for k, (s, v) in left.items()}
        best = min(rate, key=rate.get)
        order.append(best)
        alive = ~left[best][1] if alive is None else alive & ~left[best][1]
        del left[best]
    return order + [k for k in RULES if k not in order]


def judge(rows: list[bytes], order: list[str]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Base counts, base_failed and kept of some texts; a rule sees only what earlier ones left."""
    whole = Slice(rows)
    failed = base_failed(whole.base)
    alive = np.flatnonzero(~failed)
    left = whole.take(~failed)
    for name in order:
        if not alive.size:
            break
        ok = ~RULES[name](left)
        alive, left = alive[ok], left.take(ok)
    kept = np.zeros(len(rows), bool)
    kept[alive] = True
    return whole.base, failed, kept


def with_verdict(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> tuple[DataFrame, str]:
    """``docs`` with one more struct column (base counts, base_failed, kept), and its name."""
    order = plan(measure(docs, text_col, sample_rows))
    name = free_name(docs, "quality")
    kind = T.StructType([*(T.StructField(c, T.LongType()) for c in BASE), T.StructField("base_failed", T.BooleanType()),
                         T.StructField("kept", T.BooleanType())])

    def run(batches):
        for part in slices(batches, text_col):
            base, failed, kept = judge(texts(part, text_col), order)
            columns = [*(pa.array(base[c], pa.int64()) for c in BASE), pa.array(failed), pa.array(kept)]
            yield append(part, **{name: pa.StructArray.from_arrays(columns, names=[*BASE, "base_failed", "kept"])})
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)])), name


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: id, the base counts, base_failed and kept."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out, name = with_verdict(src, **options)
    return out.select("doc_id", *[F.col(name)[c].alias(c) for c in (*BASE, "base_failed", "kept")])
