"""Packing of tokenized documents into fixed windows by Karmarkar-Karp multiway differencing.

A document becomes its token ids plus one closing id. It is cut into pieces:
whole windows are sequences of their own; what is left is cut into pieces of at
most ``piece`` ids, and a group of such pieces is dealt over ``k`` windows, where
``k`` is the least that their total needs. The differencing method keeps a heap
of partial partitions (``k`` loads each), and merges the two with the largest
imbalance so that the heaviest window of one meets the lightest of the other,
until one near-equal partition is left. If a window then exceeds the capacity,
the count rises and the group is dealt again.

Scale: a group is a run of documents of one input split with about
``group_windows`` windows of loose pieces; nothing is shuffled and memory is
bounded by the group. Token ids per part of a word are kept by a Python worker for
its later tasks, up to ``BYTES_KEPT`` bytes of them. ``sequence_id`` is the task's partition number (upper bits)
and a running number, so a task that runs again gives the same rows.

Defined cases: null or empty text is one piece with the closing id; repeated
rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import kept_in_worker, slices, texts

WINDOW = 2048
PIECE = 512
GROUP_WINDOWS = 192
#: Bytes of words and ids that a worker keeps, and what an entry takes besides.
BYTES_KEPT, ENTRY_BYTES = 144 << 20, 180


#: Letters that the tokenizer's normalizer and pre-tokenizer keep in one run: ASCII's and Latin-1's, in UTF-8.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: ASCII's signs: at the end of a word, a run of its own to the pre-tokenizer, where what is before them is such letters or ends in a letter or digit of ASCII.
_SIGNS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())
_BEFORE_SIGNS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+\z|[A-Za-z0-9]\z"


def _cells(strings: pa.Array, skip: np.ndarray | int = 0) -> list[bytes]:
    """UTF-8 bytes of large strings without nulls, each without its first ``skip`` bytes."""
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset: strings.offset + len(strings) + 1]
    body = data.to_pybytes() if data else b""
    return [body[lo:hi] for lo, hi in zip((at[:-1] + skip).tolist(), at[1:].tolist(), strict=True)]


class WordTokenizer:
    """Ids of whole texts, by way of the ids of their words between ASCII white space.

    The tokenizer's normalizer and pre-tokenizer work on each such word alone
    and drop white space, so a text's ids are its words' ids in turn. Arrow splits the texts and
    tells their distinct words; only these are looked up. Two things
    that change no ids make words repeat more often: words of ASCII alone are put
    in lower case (not where a special token may stand, whose case matters; other
    words stay as they are, since the tokenizer composes letters and marks before it
    lower-cases, and some pairs compose in one case only), and a word that ends in ASCII signs after a letter of ASCII or Latin-1 or a digit
    is kept as the two parts that the pre-tokenizer would make of it (not where a special token may stand).
    """

    def __init__(self, path: str, keep: int = BYTES_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model, self.keep = Tokenizer.from_file(path), keep
        # the tokens that end a run of letters or signs, where the vocabulary marks them
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        self.closes = np.zeros(self.model.get_vocab_size(), bool)
        if suffix:
            self.closes[[i for token, i in self.model.get_vocab().items() if token.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.part: dict[bytes, int] = {b"": 0}  # a part's place in ``starts`` and ``sizes``; part 0 is empty
        self.flat = np.empty(0, np.uint32)  # the parts' ids
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.held = 0

    def _ids(self, parts: list[str], together: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts, and how many each has."""
        if together and parts and self.closes.any():
            # letters alone make one run each: encoded together, told apart by the tokens that close a run
            ids = np.fromiter(chain.from_iterable(e.ids for e in self.model.encode_batch_fast([" ".join(parts[i:i + 50]) for i in range(0, len(parts), 50)], add_special_tokens=False)), np.uint32)
            last = np.flatnonzero(self.closes[ids])
            if last.size == len(parts) and last[-1] == ids.size - 1:
                return ids, np.diff(np.concatenate(([-1], last)))
        every = [e.ids for e in self.model.encode_batch_fast(parts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(every), np.uint32), np.array(list(map(len, every)), np.int64)

    def _places(self, parts: list[bytes]) -> np.ndarray:
        """The parts' places; new ones are learnt."""
        found = np.fromiter(map(self.part.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            plain, other = {}, {}
            for i in missing:
                (plain if _LETTERS.fullmatch(parts[i]) else other)[parts[i]] = None
            for new, together in ((list(plain), True), (list(other), False)):
                ids, sizes = self._ids([p.decode("utf-8", "replace") for p in new], together)
                base = len(self.part)
                self.part.update(zip(new, range(base, base + len(new)), strict=True))
                self.held += sum(map(len, new)) + 4 * ids.size + ENTRY_BYTES * len(new)
                self.starts = np.concatenate([self.starts, self.flat.size + np.cumsum(sizes) - sizes])
                self.sizes = np.concatenate([self.sizes, sizes])
                self.flat = np.concatenate([self.flat, ids])
            found[missing] = [self.part[parts[i]] for i in missing]
        return found

    def _pairs(self, words: pa.Array) -> np.ndarray:
        """The two parts of each word: all but the signs at its end, and these; or the whole word, and part 0."""
        special = pc.match_substring(words, "<|")
        low = pc.if_else(pc.and_not(pc.string_is_ascii(words), special), pc.ascii_lower(words), words)
        stem = pc.ascii_rtrim(low, characters=_SIGNS)
        size = pc.binary_length(stem)
        apart = pc.and_(pc.and_not(pc.less(size, pc.binary_length(low)), special), pc.match_substring_regex(stem, _BEFORE_SIGNS))
        stems = pc.if_else(apart, stem, low).dictionary_encode()
        pair = np.zeros((len(words), 2), np.int64)
        pair[:, 0] = self._places(_cells(stems.dictionary))[stems.indices.to_numpy()]
        pair[apart.to_numpy(zero_copy_only=False), 1] = self._places(_cells(low.filter(apart), size.filter(apart).to_numpy()))
        return pair

    def encode(self, rows: list[bytes], close: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each followed by ``close``; and the offsets of their starts."""
        if self.held > self.keep:
            self._clear()
        split = pc.ascii_split_whitespace(pa.array(rows, pa.large_binary()).view(pa.large_string()))
        words = split.values.dictionary_encode()
        # ids of the distinct words, then of all of them
        part = self._pairs(words.dictionary)
        n = self.sizes[part]
        own = self.flat[_spans(self.starts[part].ravel(), n.ravel())]
        n = n.sum(axis=1)
        which = words.indices.to_numpy()
        every, until = n[which], np.concatenate(([0], np.cumsum(n[which])))
        last = until[split.offsets.to_numpy()[1:]]
        ids = np.insert(own[_spans((np.cumsum(n) - n)[which], every)], last, close) if own.size else np.full(len(rows), close, np.uint32)
        return ids, np.concatenate(([0], last + np.arange(1, len(rows) + 1)))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of consecutive spans, one span after the other."""
    until = np.cumsum(sizes)
    return np.arange(int(until[-1]) if until.size else 0) + np.repeat(starts - until + sizes, sizes)


def difference(sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Karmarkar-Karp over ``k`` windows: the window of each size, and the windows' loads."""
    follow = np.full(len(sizes), -1, np.int64)  # the item after this one in its window
    heap = []
    for i, s in enumerate(sizes):
        loads, head, tail = np.zeros(k, np.int64), np.full(k, -1, np.int64), np.full(k, -1, np.int64)
        loads[0], head[0], tail[0] = s, i, i
        heap.append((-s, i, loads, head, tail))
    heapq.heapify(heap)
    tick = len(sizes)
    while len(heap) > 1:
        _, _, la, ha, ta = heapq.heappop(heap)
        _, _, lb, hb, tb = heapq.heappop(heap)
        lb, hb, tb = lb[::-1], hb[::-1], tb[::-1]  # heaviest against lightest
        both = (ta >= 0) & (hb >= 0)
        follow[ta[both]] = hb[both]
        loads = la + lb
        head, tail = np.where(ha >= 0, ha, hb), np.where(tb >= 0, tb, ta)
        order = np.argsort(-loads, kind="stable")
        loads = loads[order]
        heapq.heappush(heap, (int(loads[-1] - loads[0]), tick, loads, head[order], tail[order]))
        tick += 1
    where = np.zeros(len(sizes), np.int64)
    if not heap:
        return where, np.zeros(k, np.int64)
    _, _, loads, head, _ = heap[0]
    window, at = np.arange(k)[head >= 0], head[head >= 0]
    while at.size:
        where[at] = window
        at = follow[at]
        window, at = window[at >= 0], at[at >= 0]
    return where, loads


def deal(sizes: list[int], capacity: int = WINDOW) -> np.ndarray:
    """The window of each size; no window holds more than ``capacity``."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        where, loads = difference(sizes, k)
        if loads.max(initial=0) <= capacity:
            return where
        over = int(np.maximum(loads - capacity, 0).sum())
        k += max(1, over // (4 * capacity))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", close_id: int = 1, window: int = WINDOW,
         piece: int = PIECE, group_windows: int = GROUP_WINDOWS, with_ids: bool = False) -> DataFrame:
    """One row a piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and the ids)."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        model = kept_in_worker(("word tokenizer", tokenizer_path), lambda: WordTokenizer(tokenizer_path))
        context = TaskContext.get()
        next_id = (context.partitionId() if context else 0) << 32
        loose: list[tuple] = []  # (doc_id scalar, start, length, crc, doc_tokens, ids)
        held = 0

        def rows(pieces, sequence, offset):
            columns = [pa.array([p[0] for p in pieces], arrow_id)]
            values = ([p[1] for p in pieces], [p[2] for p in pieces], [p[3] for p in pieces], [p[4] for p in pieces], sequence, offset)
            columns += [pa.array(v, pa.int64()) for v in values]
            if with_ids:
                columns.append(pa.array([p[5] for p in pieces], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", *names] + ["ids"] * with_ids)

        def close_group():
            nonlocal next_id, loose, held
            where = deal([p[2] for p in loose], window)
            used, compact = np.unique(where, return_inverse=True)
            fill, offset = [0] * used.size, []
            for p, w in zip(loose, compact.tolist(), strict=True):
                offset.append(fill[w])
                fill[w] += p[2]
            out = rows(loose, (compact + next_id).tolist(), offset)
            next_id, loose, held = next_id + used.size, [], 0
            return out

        arrow_id = None
        for part in slices(batches, "text", 2 << 20):
            arrow_id = part.schema.field("doc_id").type
            ids, starts = model.encode(texts(part, "text"), close_id)
            full: list[tuple] = []
            for doc, lo, hi in zip(part.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                n, at = hi - lo, 0
                while at < n:
                    size = window if n - at >= window else min(piece, n - at)
                    own = ids[lo + at: lo + at + size]
                    row = (doc, at, size, zlib.crc32(own.astype("<u4").tobytes()), n, own if with_ids else None)
                    at += size
                    if size == window:
                        full.append(row)
                    else:
                        loose.append(row)
                        held += size
                        if held >= window * group_windows:
                            yield close_group()
            if full:
                yield rows(full, list(range(next_id, next_id + len(full))), [0] * len(full))
                next_id += len(full)
        if loose:
            yield close_group()

    return src.mapInArrow(run, schema + ", ids array<int>" * with_ids)
