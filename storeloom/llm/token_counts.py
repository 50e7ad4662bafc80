"""Token counts by a count-only Viterbi search over a unigram vocabulary.

A text is cut as the unigram tokenizer does: each space becomes ``U+2581``, one
is put in front unless the text begins with one, and every segment begins at
such a mark. In a segment an Aho-Corasick automaton enumerates the vocabulary
matches by their end; for each end, dynamic programming keeps the best score,
the number of tokens on that path and whether it ends in an unknown character,
never the path itself.

Tie rules, as in the public ``tokenizers`` library: scores are 64-bit sums from
left to right; a path replaces another only if its score is greater, and
candidates for an end come with earlier starts first (longest match first). A
character that is no vocabulary entry costs the lowest score less 10; runs of
such characters count one token, or one a byte if the vocabulary holds all byte
pieces (byte fallback).

The public vocabularies at hand hold no unigram scores, and tokenizers aren't
trained here: :func:`zipf_vocabulary` gives the pieces of a sentencepiece file
the log-probabilities of Zipf's law by their order. Any list of (piece, score)
works. Scale: one map, no shuffle; counts of distinct segments of at most
``SEGMENT_KEPT`` characters are kept for a task, up to ``SEGMENTS_KEPT``. A segment
of any length is searched with as many cells as the longest piece has characters.
Defined cases: null and empty text have 0 tokens;
repeated rows are counted each.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeloom.llm.common import slices, texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
SEGMENTS_KEPT = 500_000
#: The longest segment, in characters, whose count is kept.
SEGMENT_KEPT = 64


def zipf_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) in file order and the unknown piece's place; byte and control pieces get the lowest score."""
    from sentencepiece import SentencePieceProcessor
    model = SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(plain))))
    scores = dict.fromkeys(range(n), -math.log(len(plain) + 1) - total) | {i: -math.log(r + 1) - total for r, i in enumerate(plain)}
    return [(model.id_to_piece(i), scores[i]) for i in range(n)], model.unk_id()


class PieceCounter:
    def __init__(self, vocabulary: list[tuple[str, float]], keep: int = SEGMENTS_KEPT):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        pieces = {p for p, _ in vocabulary}
        self.longest = max(map(len, pieces), default=1)
        self.single = {p for p in pieces if len(p) == 1}
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.keep, self.known = keep, {}
        self.cut = re.compile(f"{MARK}[^{MARK}]*")

    def segment(self, text: str) -> int:
        """Tokens on the best path of one segment; as many positions are held as the longest piece has characters, and one more."""
        width = self.longest + 1
        score, count = [0.0] * width, [0] * width
        found = self.automaton.iter(text)
        match, run_open = next(found, None), False
        for end, char in enumerate(text, 1):
            ending = []
            while match is not None and match[0] == end - 1:
                ending.append(match[1])
                match = next(found, None)
            best, pieces, reached, unknown = 0.0, 0, False, False
            for size, own in sorted(ending, reverse=True):
                start = (end - size) % width
                value = own + score[start]
                if not reached or value > best:
                    best, pieces, reached = value, count[start] + 1, True
            if char not in self.single:
                before = (end - 1) % width
                value = self.unknown + score[before]
                if not reached or value > best:
                    best, unknown = value, True
                    pieces = count[before] + (len(char.encode()) if self.bytes else not run_open)
            score[end % width], count[end % width], run_open = best, pieces, unknown
        return count[len(text) % width]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if not text.startswith(MARK):
            text = MARK + text
        known, total = self.known, 0
        if len(known) > self.keep:
            known.clear()
        for part in self.cut.findall(text):
            n = known.get(part)
            if n is None:
                n = self.segment(part)
                if len(part) <= SEGMENT_KEPT:  # longer ones seldom repeat, and the cache's bound is a number of segments
                    known[part] = n
            total += n
        return total


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars (code points), n_tokens."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    words = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        counter = PieceCounter(words.value)
        for part in slices(batches, "text"):
            rows = [t.decode("utf-8", "replace") for t in texts(part, "text")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, rows), pa.int64()), pa.array(map(counter.count, rows), pa.int64())],
                                             names=["doc_id", "n_chars", "n_tokens"])
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_chars long, n_tokens long")
