"""Alignment of two tokenizers' tokens, with an identity map for what both cut alike.

A text's tokens of tokenizer A (byte-level pairs, over space + text) and of B
(pieces, which adds that space) are laid over the same bytes. Where both end a
token the bytes are cut into groups; the two tokens that end there are a link.
Nearly all groups are one A token and one B token of the same bytes: for those
an array, made once, gives each A id the B id of the same bytes, and their links
are counted in vectors as long as A's vocabulary. Only what is left, the links of
irregular groups, is counted by (A id, B id) in a shuffle. Two tokens of the same
bytes that end together begin together, so a pair is counted in one place only.

Neither tokenizer joins anything over a space that follows a character other
than white space, so texts are cut there and the pieces of text between, which
repeat, are encoded once for a worker, which keeps ``CACHE_BYTES`` of them. A text
in which any piece's tokens don't spell the piece is compared as a whole.

Scale: texts are read and encoded once; what each document links is landed as
arrays of (id, count). Vectors of a vocabulary's length and the ``HOT`` most
frequent irregular pairs are broadcast (sizes fixed); the rare ones are joined by
(A id, B id), added up for each document first.

Defined cases: null and empty texts, and texts whose tokens don't spell space +
text, have zeros and the empty string; repeated rows are counted each; an empty
table gives no rows; null ids stay.
"""

from __future__ import annotations

import hashlib
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.common import joined, kept_in_worker, slices, texts
from storeloom.session import scratch_folder

CACHE_BYTES = 96 << 20
HOT = 1 << 16


def byte_level_alphabet() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable Latin-1 stands for itself, the rest for 256 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        alphabet = byte_level_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        first: dict[bytes, int] = {}
        for i, own in enumerate(self.b_bytes):
            if not (self.b.is_control(i) or self.b.is_unknown(i)):
                first.setdefault(own, i)
        #: The B id of the same bytes as each A id; -1 where there is none.
        self.same = np.array([first.get(own, -1) for own in self.a_bytes], np.int32)
        self.a_size, self.b_size = (np.array(list(map(len, own)), np.int64) for own in (self.a_bytes, self.b_bytes))
        #: Ids as text: A's inside a group and at its end, then B's.
        self.written = [f"{i}{sign}".encode() for n, signs in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for sign in signs for i in range(n)]
        self.written_size = np.array(list(map(len, self.written)), np.int64)

    def encode(self, parts: list[bytes]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of parts that begin with a space, and whether both spell the part."""
        strings = [p.decode("utf-8", "replace") for p in parts]
        a = [e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)]
        b = self.b.encode([p[1:] for p in strings], num_threads=1)
        good = np.array([b"".join(map(self.a_bytes.__getitem__, x)) == p == b"".join(map(self.b_bytes.__getitem__, y)) for x, y, p in zip(a, b, parts, strict=True)], bool)
        return a, b, good

    def groups(self, a: list[list[int]], b: list[list[int]]) -> tuple[np.ndarray, list[bytes], tuple, tuple]:
        """Of parts that both spell: numbers of tokens and groups, groups as text (each with its sign at the end), links of either kind with their numbers."""
        n_a, n_b = (np.array(list(map(len, own)), np.int64) for own in (a, b))
        a, b = (np.fromiter(chain.from_iterable(own), np.int64) for own in (a, b))
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        at = np.minimum(np.searchsorted(end_b, end_a), max(0, end_b.size - 1))
        last_a = np.flatnonzero(end_b[at] == end_a) if a.size else at
        last_b = at[last_a]
        part = np.searchsorted(np.cumsum(n_a), last_a, "right")
        before_a, before_b = np.concatenate(([-1], last_a))[:-1], np.concatenate(([-1], last_b))[:-1]
        one = (last_a - before_a == 1) & (last_b - before_b == 1) & (self.same[a[last_a]] == b[last_b])
        link = np.stack([a[last_a], b[last_b]], axis=1).astype(np.int32)
        per_part = lambda which: np.bincount(part[which], minlength=n_a.size)
        codes = np.empty(a.size + b.size, np.int64)
        of_a, of_b = np.searchsorted(last_a, np.arange(a.size)), np.searchsorted(last_b, np.arange(b.size))
        own = a.copy()
        own[last_a] += len(self.a_bytes)
        codes[np.arange(a.size) + (before_b + 1)[of_a]] = own
        own = b + 2 * len(self.a_bytes)
        own[last_b] += len(self.b_bytes)
        codes[np.arange(b.size) + (last_a + 1)[of_b]] = own
        text = b"".join(map(self.written.__getitem__, codes.tolist()))
        ends = np.concatenate(([0], np.cumsum(self.written_size[codes])))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        numbers = np.stack([n_a, n_b, per_part(slice(None))], axis=1)
        return numbers, [text[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)], (link[one, 0], per_part(one)), (link[~one], per_part(~one))


class Aligned:
    """What is known of the pieces of text that a worker has met: bounded in bytes."""

    def __init__(self, tokenizers: Tokenizers, cache_bytes: int = CACHE_BYTES):
        self.t, self.cache_bytes = tokenizers, cache_bytes
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.held = 0
        self.text: list[bytes | None] = []  # a piece's groups as text; None where its tokens don't spell it
        self.n = np.empty((0, 3), np.int64)  # tokens of A, of B, groups
        self.one, self.one_ends = np.empty(0, np.int32), np.zeros(1, np.int64)  # A ids of one-to-one links
        self.odd, self.odd_ends = np.empty((0, 2), np.int32), np.zeros(1, np.int64)  # other links
        self.met = np.empty(0, np.int32)  # slices in which a piece was met

    def shrink(self) -> None:
        """Forget the pieces that were met in one slice only, or all if that leaves many."""
        keep, names = np.flatnonzero(self.met > 1), list(self.number)
        if 2 * keep.size > len(names):
            return self.clear()
        self.held = int(self.held * keep.size / len(names))
        self.number = {names[i]: k for k, i in enumerate(keep.tolist())}
        self.text = [self.text[i] for i in keep.tolist()]
        self.one, n_one = _gather(self.one, self.one_ends, keep)
        self.odd, n_odd = _gather(self.odd, self.odd_ends, keep)
        self.one_ends, self.odd_ends = (np.concatenate(([0], np.cumsum(n))) for n in (n_one, n_odd))
        self.n, self.met = self.n[keep], np.ones(keep.size, np.int32)

    def learn(self, parts: list[bytes]) -> None:
        counts, one, odd, ones, odds = [self.n], [self.one], [self.odd], [], []
        for k in range(0, len(parts), 2000):
            fresh = parts[k:k + 2000]
            a, b, good = self.t.encode(fresh)
            numbers, text, (x, n_x), (y, n_y) = self.t.groups([i for i, g in zip(a, good, strict=True) if g], [i for i, g in zip(b, good, strict=True) if g])
            own, per = np.zeros((len(fresh), 3), np.int64), np.zeros((2, len(fresh)), np.int64)
            own[good], per[:, good] = numbers, (n_x, n_y)
            text = iter(text)
            self.text += [next(text) if g else None for g in good]
            counts.append(own)
            one.append(x)
            odd.append(y)
            ones.append(per[0])
            odds.append(per[1])
            self.held += 260 * len(fresh) + 2 * sum(map(len, fresh)) + 24 * int(own.sum())
        self.number.update(zip(parts, range(len(self.number), len(self.number) + len(parts)), strict=True))
        self.n, self.one, self.odd = np.concatenate(counts), np.concatenate(one), np.concatenate(odd)
        self.one_ends, self.odd_ends = (np.concatenate([was, was[-1] + np.cumsum(np.concatenate(n))]) for was, n in ((self.one_ends, ones), (self.odd_ends, odds)))

    def numbers(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the texts' pieces, all texts in turn; where each text's begin."""
        if self.held > self.cache_bytes:
            self.shrink()
        found, starts = pieces(rows)
        distinct = found.dictionary.to_pylist()
        missing = [p for p in distinct if p not in self.number]
        if missing:
            self.learn(missing)
        own = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))
        self.met = np.concatenate([self.met, np.zeros(len(self.number) - self.met.size, np.int32)])
        self.met[own] += 1
        return own[found.indices.to_numpy()], starts


def pieces(rows: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Space + text, cut before each space that follows a character other than white space; where each text's begin.

    An empty text has no piece. A cut that is left out does no harm, so control
    characters that some call white space count as white space here.
    """
    data, starts = joined([b" " + t if t else t for t in rows])
    flat = np.frombuffer(data, np.uint8)
    space = np.flatnonzero(flat == 32)
    one, two, three = (flat[np.maximum(space - k, 0)] for k in (1, 2, 3))
    blank = (one <= 32) & ((one >= 28) | (one >= 9) & (one <= 13))
    blank |= (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    blank |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    blank |= (three == 0xE2) & (two == 0x81) & (one == 0x9F) | (three == 0xE3) & (two == 0x80) & (one == 0x80) | (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    begin = np.union1d(space[~blank], starts[:-1][np.diff(starts) > 0])
    offsets = np.concatenate((begin, [flat.size])).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), begin.size, [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    return found, np.searchsorted(begin, starts)


def _gather(values: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each part of ``which`` in turn, and how many each has."""
    n = np.diff(ends)[which]
    until = np.cumsum(n)
    return values[np.arange(int(until[-1]) if until.size else 0) - np.repeat(until - n - ends[which], n)], n


def _counted(row: np.ndarray, key: np.ndarray, n_rows: int, span: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Offsets by row, distinct keys of each row and their counts."""
    code, n = np.unique(row * span + key, return_counts=True)
    return pa.array(np.searchsorted(code // span, np.arange(n_rows + 1)), pa.int32()), code % span, n


_LANDED = "doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, one array<int>, one_n array<int>, odd_a array<int>, odd_b array<int>, odd_n array<int>"


def _links(src: DataFrame, a_path: str, b_path: str, cache_bytes: int) -> DataFrame:
    """Per document: its numbers, its one-to-one links by A id and its other links by both ids, with counts."""
    def run(batches):
        t = kept_in_worker(("alignment", "tokenizers", a_path, b_path), lambda: Tokenizers(a_path, b_path))
        known = kept_in_worker(("alignment", "pieces", a_path, b_path), lambda: Aligned(t, cache_bytes))
        span_b = len(t.b_bytes)
        for part in slices(batches, "text", 1 << 20):
            rows = texts(part, "text")
            found, starts = known.numbers(rows)
            bad = {int(np.searchsorted(starts, k, "right")) - 1 for k in np.flatnonzero([known.text[x] is None for x in found.tolist()]).tolist()}
            alone = {i: _whole(t, rows[i]) for i in bad}
            row = np.repeat(np.arange(len(rows)), np.diff(starts))
            good = ~np.isin(row, list(bad)) if bad else np.ones(row.size, bool)
            row, found = row[good], found[good]
            numbers = np.zeros((len(rows), 3), np.int64)
            np.add.at(numbers, row, known.n[found])
            one, n = _gather(known.one, known.one_ends, found)
            one_row = np.repeat(row, n)
            odd, n = _gather(known.odd, known.odd_ends, found)
            odd_row = np.repeat(row, n)
            digests = []
            for i in range(len(rows)):
                if i in alone:
                    numbers[i], text, x, y = alone[i]
                    one, one_row = np.concatenate([one, np.array(x, np.int32)]), np.concatenate([one_row, np.full(len(x), i)])
                    odd, odd_row = np.concatenate([odd, np.array(y, np.int32).reshape(-1, 2)]), np.concatenate([odd_row, np.full(len(y), i)])
                else:
                    lo, hi = np.searchsorted(row, (i, i + 1))
                    text = b"".join(map(known.text.__getitem__, found[lo:hi].tolist()))
                digests.append(hashlib.sha256(text[:-1]).hexdigest() if text else "")
            at_one, key_one, n_one = _counted(one_row, one.astype(np.int64), len(rows), len(t.a_bytes))
            at_odd, key_odd, n_odd = _counted(odd_row, odd[:, 0].astype(np.int64) * span_b + odd[:, 1], len(rows), len(t.a_bytes) * span_b)
            ints = lambda at, x: pa.ListArray.from_arrays(at, pa.array(x, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(numbers[:, k]) for k in range(3)), pa.array(digests, pa.string()), ints(at_one, key_one), ints(at_one, n_one),
                 ints(at_odd, key_odd // span_b), ints(at_odd, key_odd % span_b), ints(at_odd, n_odd)],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "one", "one_n", "odd_a", "odd_b", "odd_n"])
    return src.mapInArrow(run, _LANDED.format(id=src.schema["doc_id"].dataType.simpleString()))


def _whole(t: Tokenizers, text: bytes) -> tuple:
    """Numbers, groups as text, one-to-one links and others of a text that is encoded at once."""
    a, b, good = t.encode([b" " + text])
    if not good[0]:
        return (0, 0, 0), b"", [], []
    numbers, written, (one, _), (odd, _) = t.groups(a, b)
    return numbers[0], written[0], one, odd


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    root = scratch_folder(spark, "alignment")
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    _links(src, a_path, b_path, cache_bytes).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{root}/links")
    links = spark.read.parquet(f"{root}/links")
    same = Tokenizers(a_path, b_path).same

    def regular(batches):
        vector = np.zeros(same.size, np.int64)
        for batch in batches:
            np.add.at(vector, batch.column("one").flatten().to_numpy(), batch.column("one_n").flatten().to_numpy())
        at = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(vector[at])], names=["a", "n"])
    count = np.zeros(same.size, np.int64)
    for r in links.select("one", "one_n").mapInArrow(regular, "a int, n long").groupBy("a").agg(F.sum("n").alias("n")).collect():
        count[r["a"]] = r["n"]
    pair = F.explode(F.arrays_zip("odd_a", "odd_b", "odd_n")).alias("p")
    links.select(pair).groupBy("p.odd_a", "p.odd_b").agg(F.sum("p.odd_n").alias("n")).select(F.col("odd_a").alias("a"), F.col("odd_b").alias("b"), "n").write.parquet(f"{root}/pairs")
    pairs = spark.read.parquet(f"{root}/pairs")
    best = np.zeros(int(same.max(initial=0)) + 1, np.int64)
    np.maximum.at(best, same[same >= 0], count[same >= 0])
    for r in pairs.groupBy("b").agg(F.max("n").alias("n")).collect():  # as many rows as B has pieces, at most
        if r["b"] >= best.size:
            best = np.concatenate([best, np.zeros(r["b"] + 1 - best.size, np.int64)])
        best[r["b"]] = max(best[r["b"]], r["n"])
    often = pairs.orderBy(F.desc("n"), "a", "b").limit(hot).collect()
    code = np.array([r["a"] << 32 | r["b"] for r in often], np.int64)
    order = np.argsort(code)
    sent = spark.sparkContext.broadcast((count, best, same, code[order], np.array([r["n"] for r in often], np.int64)[order]))

    def known(batches):
        count, best, same, code, often = sent.value
        for batch in batches:
            one, one_n, a, b, n = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("one", "one_n", "odd_a", "odd_b", "odd_n"))
            rows = batch.num_rows
            row_one = np.repeat(np.arange(rows), np.diff(batch.column("one").offsets.to_numpy()))
            row_odd = np.repeat(np.arange(rows), np.diff(batch.column("odd_a").offsets.to_numpy()))
            key = a << 32 | b
            at = np.minimum(np.searchsorted(code, key), max(0, code.size - 1))
            met = code[at] == key if code.size else np.zeros(key.size, bool)
            value = often[at[met]] if code.size else np.zeros(0, np.int64)
            sums, tops = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(sums, row_one, one_n * count[one])
            np.add.at(tops, row_one, one_n * (count[one] == best[same[one]]))
            np.add.at(sums, row_odd[met], n[met] * value)
            np.add.at(tops, row_odd[met], n[met] * (value == best[b[met]]))
            at = pa.array(np.searchsorted(row_odd[~met], np.arange(rows + 1)), pa.int32())
            rest = [pa.ListArray.from_arrays(at, pa.array(x[~met].astype(np.int32))) for x in (a, b, n)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, own), pa.array(tops), pa.array(sums), *rest], names=[*own, "n_best", "count_sum", "rest_a", "rest_b", "rest_n"])
    own = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    kinds = T.StructType([*(links.schema[c] for c in own), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                          *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("rest_a", "rest_b", "rest_n"))])
    links.mapInArrow(known, kinds).write.parquet(f"{root}/known")
    base = spark.read.parquet(f"{root}/known")
    top = spark.createDataFrame([(i, int(x)) for i, x in enumerate(best.tolist())], "b int, top long")  # a row for each piece of B
    rare = base.select("row", F.explode(F.arrays_zip("rest_a", "rest_b", "rest_n")).alias("p")).select("row", F.col("p.rest_a").alias("a"), F.col("p.rest_b").alias("b"), F.col("p.rest_n").alias("times"))
    rare = rare.join(pairs.join(top, "b"), ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    out = base.drop("rest_a", "rest_b", "rest_n").join(rare, "row", "left")
    more = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).cast("long").alias(c)
    return out.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), more("n_best", "more_best"), more("count_sum", "more_sum"), "groups_sha256")
