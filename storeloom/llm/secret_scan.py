"""Secret scan with a recursive decoding worklist.

Three kinds are searched, leftmost and non-overlapping each: ``assign`` (a name
such as password or api_key, then a value of 6 or more characters), ``access``
(``AKIA`` and capitals or digits, 20 or more in all) and ``hex`` (24 or more
lower-case hexadecimal digits).

The text itself is the first layer. Each layer that comes off the worklist is
scanned, then unwrapped: percent escapes, Unicode escapes (``\\uXXXX``,
``\\u{X}``, ``&#N;``, ``&#xH;``) and long base64 runs give further layers, until
none is new. A base64 run goes over single line ends and is decoded at all four
alignments, so other characters of the alphabet may be glued to it. Decoded bytes
are layers too, of percent escapes as of base64: they are read as UTF-8, whatever
else is among them, and as UTF-16, and gzip and zlib streams in them are
unpacked, all members, into bytes that are looked through in the same way; of a
damaged stream everything before the damage counts, checksums aren't looked at. A
layer with the content and the spans of one seen before in the document (by
SHA-256) isn't entered again, so a stream that unpacks to itself ends. Every layer
carries, for each of its characters, the span of the original text that it comes
from; a secret found in it is reported at that span.

Scale: one map, no shuffle. Whole texts are scanned; an unpacked stream is taken
in blocks of ``BLOCK`` bytes that overlap by ``OVERLAP`` and are scanned in turn.
An encoded run or a stream that isn't finished at a block's end goes over into the
next one, up to ``LONGEST`` bytes; a longer one is cut there. The worklist holds
generators, so memory is bounded by one such block a depth of nesting. Defined
cases: null and empty text have no spans; repeated rows give equal results.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import zlib
from collections.abc import Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import slices, texts

BLOCK = 8 << 20
OVERLAP = 1 << 14
#: Bytes that a decompressor is fed at a time.
INPUT = 1 << 16
#: Bytes of an unfinished run or stream that go over into the next block.
LONGEST = 8 * BLOCK

# The kinds in their order, their patterns, and the least length of what they match.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n|[\r\n])[ \t]*+[A-Za-z0-9+/_-]++)++|[A-Za-z0-9+/_-]{16,}+)={0,2}")
_GAPS = re.compile(r"[ \t\r\n=]+")
MIN_BASE64 = 16
_STREAM = re.compile(rb"\x1f\x8b\x08[\0-\x1f]|\x78[\x01\x5e\x9c\xda]")
#: ASCII characters of UTF-16 text, least byte first and last.
_WIDE = re.compile(rb"(?:[\x01-\x7f]\0){6,}"), re.compile(rb"(?:\0[\x01-\x7f]){6,}")
_RUN = re.compile(rb"(?:[A-Za-z0-9+/_-][ \t\r\n]*+){16}")
_HEX = re.compile(HEX.pattern.encode())
_PARTS = re.compile(r"[/_\r\n-]")
#: An encoded run that reaches the end, on reversed bytes.
_OPEN = re.compile(rb"[A-Za-z0-9+/_=%&#;{}\\-]*(?:[ \t]*(?:\n\r?|\r)[ \t]*[A-Za-z0-9+/_=%&#;{}\\-]+)*")

Span = tuple[int, int, int]  # start, kind, end


def scan(text: str) -> Iterator[Span]:
    """Spans of the three kinds in one layer."""
    low = text.lower()
    if any(name in low for name in NAMES):
        yield from ((m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE)
    if "AKIA" in text:
        yield from ((m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS)
    yield from ((m.start(), 2, m.end()) for m in HEX.finditer(text))


def _worth(data: bytes) -> bool:
    """Whether a secret or a further layer can be in the bytes."""
    low = data.lower()
    return (any(name.encode() in low for name in NAMES) or any(x in data for x in (b"AKIA", b"%", b"\\u", b"&#"))
            or any(x.search(data) for x in (_HEX, _RUN, _STREAM, *(_WIDE if b"\0" in data else ()))))


class Layer:
    """A decoded text, or bytes; ``start`` and ``end`` give each item's span in the original (None: itself; a number: of all).

    For streams in it, ``until`` is where the encoded form ends and ``begins`` has the places where a part of it begins.
    """

    begins: frozenset[int] = frozenset((0,))

    def __init__(self, data: str | bytes, start: np.ndarray | int | None = None, end: np.ndarray | int | None = None, until: int | None = None):
        self.data, self.start, self.end, self.until = data, start, end, until

    @property
    def fixed(self) -> bool:
        return isinstance(self.start, int)

    def origin(self, lo: int, hi: int) -> tuple[int, int]:
        if self.start is None:
            return lo, hi
        if self.fixed:
            return self.start, self.end
        return int(self.start[lo]), int(self.end[hi - 1])

    def mapped(self, data: str | bytes, lo: np.ndarray | None, hi: np.ndarray | None, until: int | None = None) -> Layer:
        """A layer whose items come from ``lo`` to ``hi`` (arrays, not needed where all have one span) in this one."""
        if self.fixed:
            return Layer(data, self.start, self.end)
        return Layer(data, lo, hi, until) if self.start is None else Layer(data, self.start[lo], self.end[hi - 1], until)

    def rewritten(self, parts: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer:
        """The layer with (from, to, new text, span of each new character in this layer) put in."""
        text, start, end, at = [], [], [], 0
        for lo, hi, new, where in [*parts, (len(self.data), len(self.data), "", [])]:
            text += [self.data[at:lo], new]
            if not self.fixed:
                start += [np.arange(at, lo), np.array([a for a, _ in where], np.int64)]
                end += [np.arange(at + 1, lo + 1), np.array([b for _, b in where], np.int64)]
            at = hi
        if self.fixed:
            return self.mapped("".join(text), None, None)
        return self.mapped("".join(text), np.concatenate(start), np.concatenate(end))


def _sizes(text: str) -> np.ndarray:
    """The UTF-8 bytes of each character; 1 for a byte that isn't UTF-8, which is a character of its own that no pattern has."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where((code >= 0xDC80) & (code < 0xDD00), 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))


def _percent(layer: Layer) -> Iterator[Layer]:
    """The text with the escapes decoded, and its bytes where they hold a stream or UTF-16."""
    parts = []
    for m in _PERCENT.finditer(layer.data):
        text = bytes.fromhex(m[0].replace("%", "")).decode("utf-8", "surrogateescape")
        size = _sizes(text)
        until = m.start() + 3 * np.cumsum(size)
        parts.append((m.start(), m.end(), text, list(zip((until - 3 * size).tolist(), until.tolist(), strict=True))))
    if not parts:
        return
    new = layer.rewritten(parts)
    yield new
    data = new.data.encode("utf-8", "surrogateescape")
    if any(x.search(data) for x in (_STREAM, *_WIDE)):
        at = None if new.fixed else np.repeat(np.arange(len(new.data)), _sizes(new.data))
        inner = new.mapped(data, at, None if at is None else at + 1)
        gone = np.cumsum([0, *(hi - lo - len(text) for lo, hi, text, _ in parts)])[:-1]
        until = np.cumsum(np.concatenate(([0], _sizes(new.data))))
        inner.begins = frozenset(until[np.array([p[0] for p in parts]) - gone].tolist()) | {0}
        yield inner


def _escapes(layer: Layer) -> Layer | None:
    parts: list[tuple[int, int, str, list[tuple[int, int]]]] = []
    high = None  # a first half of a pair: its match and value
    for m in _ESCAPE.finditer(layer.data):
        code = int(m[3]) if m[3] else int(m[1] or m[2] or m[4], 16)
        if high and m.start() == high[0].end() and 0xDC00 <= code < 0xE000:
            begin, code = high[0].start(), 0x10000 + ((high[1] - 0xD800) << 10) + code - 0xDC00
        else:
            begin = m.start()
        high = (m, code) if 0xD800 <= code < 0xDC00 else None
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            parts.append((begin, m.end(), chr(code), [(begin, m.end())]))
    return layer.rewritten(parts) if parts else None


def _body(data: bytes, at: int) -> tuple[int, int] | None:
    """Where the deflate data of the stream at ``at`` begins, and the length of its trailer; None if there is no stream."""
    if not _STREAM.match(data, at):
        return None
    if data[at] == 0x78:
        return at + 2, 4
    flags, body = (data[at + 3:at + 4] or b"\0")[0], at + 10
    if flags & 4:
        body += 2 + int.from_bytes(data[body:body + 2], "little")
    for flag in (8, 16):
        if flags & flag:
            body = data.find(0, body) + 1 or len(data)
    return body + (flags & 2), 8


def _inflated(data: bytes) -> Generator[bytes, None, tuple[int, bool | None]]:
    """What the stream at the start and the members right after it hold; returns how much is done with, and if more input was wanted (None: damaged).

    A call that fails loses its output, so it is repeated from before with smaller steps.
    """
    at = 0
    while at < len(data) and (head := _body(data, at)):
        stream, pos, rest, step = zlib.decompressobj(-zlib.MAX_WBITS), head[0], b"", BLOCK
        while not stream.eof:
            if not rest:
                rest = data[pos:pos + INPUT]
                pos += len(rest)
            before = stream.copy()
            try:
                out = stream.decompress(rest, step)
            except zlib.error:
                if step == 1:  # the last byte before the damage comes out if the input ends there
                    with contextlib.suppress(zlib.error):
                        yield from filter(None, (before.decompress(rest[i:i + 1], 1) for i in range(len(rest))))
                    return at + 2, None
                stream, step = before, max(1, step >> 6)
                continue
            rest = stream.unconsumed_tail
            if out:
                yield out
            elif not rest and pos >= len(data) and not stream.eof:
                return at + 2, True
        at = pos - len(stream.unused_data) + head[1]
    return at, False


def _extent(data: bytes) -> tuple[int, bool | None]:
    """What :func:`_inflated` returns."""
    stream = _inflated(data)
    while True:
        try:
            next(stream)
        except StopIteration as end:
            return end.value


def _unfinished(block: bytes) -> int:
    """Where a further block has to begin: before the overlap, and before a run or a stream that goes on."""
    at = min(max(0, len(block) - OVERLAP), len(block) - _OPEN.match(block[::-1]).end())
    pos = 0
    while (m := _STREAM.search(block, pos)) and m.start() < at:
        used, wanting = _extent(block[m.start():])
        if wanting:
            at = m.start()
        pos = m.start() + used
    return max(at, len(block) - LONGEST)


def _unpacked(data: bytes) -> Iterator[bytes]:
    """Blocks of the stream that ``data`` begins with, with overlaps."""
    carry, parts, size = b"", [], 0
    for piece in _inflated(data):
        parts.append(piece)
        size += len(piece)
        if size >= max(BLOCK, len(carry)):  # grows with what is carried, so that it isn't read over and over
            block = carry + b"".join(parts)
            yield block
            carry, parts, size = block[_unfinished(block):], [], 0
    if parts:
        yield carry + b"".join(parts)


def _streams(layer: Layer) -> Iterator[Layer]:
    """Bytes of the streams in a layer of bytes.

    The two bytes of a zlib header occur by chance, so elsewhere than where a part begins that stream must be whole.
    """
    at = 0
    while m := _STREAM.search(layer.data, at):
        data = layer.data[m.start():]
        used, wanting = _extent(data)
        at = m.start() + used
        if wanting is not False and data[0] == 0x78 and m.start() not in layer.begins:
            continue
        lo, hi = layer.origin(m.start(), min(at, len(layer.data)) if wanting is False else len(layer.data))
        if layer.until and (wanting is not False or at >= len(layer.data)):
            hi = layer.until
        for block in _unpacked(data):
            yield Layer(block, lo, hi)


def _base64(layer: Layer) -> Iterator[Layer]:
    """Bytes of the base64 runs, at each alignment."""
    for m in _BASE64.finditer(layer.data):
        if m.end() - m.start() < MIN_BASE64:
            continue
        body = _GAPS.sub("", m[0]).replace("-", "+").replace("_", "/")
        if len(body) < MIN_BASE64:
            continue
        place = None
        for skip in range(4):
            n = len(body) - skip
            data = base64.b64decode(body[skip:len(body) - (n % 4 == 1)] + "=" * (-n % 4 if n % 4 > 1 else 0))
            if not _worth(data):
                continue
            if place is None:
                run = np.frombuffer(m[0].encode(), np.uint8)
                place = np.flatnonzero(~np.isin(run, np.frombuffer(b" \t\r\n=", np.uint8)))
            if layer.fixed:
                new = layer.mapped(data, None, None)
            else:
                i, at = np.arange(len(data)), m.start() + place
                new = layer.mapped(data, at[skip + i * 8 // 6], at[skip + (i * 8 + 7) // 6] + 1, layer.origin(m.start(), m.end())[1])
            if _STREAM.search(data):
                parts = np.searchsorted(place, [0, *(x.end() for x in _PARTS.finditer(m[0]))])
                new.begins = frozenset(((parts[(parts - skip) % 4 == 0] - skip) // 4 * 3).tolist()) | {0}
            yield new


def _text(layer: Layer) -> Iterator[Layer]:
    """The text of a layer of bytes, as UTF-8 and as UTF-16 (its stretches of ASCII, at any offset)."""
    if layer.fixed:
        yield layer.mapped(layer.data.decode("utf-8", "surrogateescape"), None, None)
    else:
        text = layer.data.decode("utf-8", "surrogateescape")
        size = _sizes(text)
        until = np.cumsum(size)
        yield layer.mapped(text, until - size, until)
    for skip, pattern in enumerate(_WIDE):
        for m in pattern.finditer(layer.data):
            lo = np.arange(m.start(), m.end(), 2)
            yield layer.mapped(m[0][skip::2].decode("ascii"), lo, lo + 2)


def _inner(layer: Layer) -> Iterator[Layer]:
    """The layers that are wrapped in this one."""
    if isinstance(layer.data, bytes):
        yield from _streams(layer)
        yield from _text(layer)
        return
    if "%" in layer.data:
        yield from _percent(layer)
    if ("\\u" in layer.data or "&#" in layer.data) and (new := _escapes(layer)):
        yield new
    yield from _base64(layer)


def find_secrets(text: str) -> tuple[list[Span], list[Span]]:
    """Spans in the text itself, and all spans; each sorted by start, kind and end."""
    base = sorted(scan(text))
    every, seen, work = set(base), set(), [_inner(Layer(text))]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif layer.data and (key := _identity(layer)) not in seen:
            seen.add(key)
            if isinstance(layer.data, str):
                for lo, kind, hi in scan(layer.data):
                    start, end = layer.origin(lo, hi)
                    every.add((start, kind, end))
            work.append(_inner(layer))
    return base, sorted(every)


def _identity(layer: Layer) -> bytes:
    text = isinstance(layer.data, str)
    digest = hashlib.sha256(b"text" if text else b"bytes")
    digest.update(layer.data.encode("utf-8", "surrogatepass") if text else layer.data)
    for where in (layer.start, layer.end):
        digest.update(b"%d" % where if isinstance(where, int) else where.tobytes())
    return digest.digest()


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for part in slices(batches, "text"):
            counts: list[list[int]] = [[], [], []]
            digests, spans = [], []
            for t in texts(part, "text"):
                base, every = find_secrets(t.decode("utf-8", "replace"))
                for kind in range(3):
                    counts[kind].append(sum(s[1] == kind for s in base))
                digests.append(hashlib.sha256(spelled(base).encode()).hexdigest())
                spans.append(spelled(every))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
