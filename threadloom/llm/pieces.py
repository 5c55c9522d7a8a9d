"""SentencePiece BPE encoding by a prefix table, and decoding.

For every prefix of a segment the table holds the last token of the prefix's
encoding, of which there is exactly one.  The tokens that end at a place come out
of an Aho-Corasick automaton; a token fits if the last token of what precedes it
is compatible, that is, if the two encode to themselves side by side.  The ids
are then read off backwards from the end.

No piece of the vocabulary continues past the start of a word, so a text is cut
there into segments; loading a vocabulary checks it.  Encodings of segments and
tests of pairs are remembered up to a fixed number of entries, encodings for one task.

Defined results: a null or empty text has the begin and end ids alone; characters
that the vocabulary lacks are written as bytes; equal texts have equal ids; an
empty table gives no rows; columns other than id and text are not looked at.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array

from pyspark.sql import DataFrame

from threadloom.llm.common import bounded_batches, kept_by_worker, whole_text

SPACE = "▁"  # what stands for a space in pieces; a fixed value of the format
REMEMBERED_SEGMENTS = 150_000
REMEMBERED_PAIRS = 400_000
REMEMBERED_LENGTH = 64
SEGMENTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")


class Pieces:
    """A BPE vocabulary with byte fallback, read from a model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        codecs.register_error("one_mark_per_byte", _one_mark_per_byte)
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if model.normalize("  A ﬁ\t ") != f"{SPACE * 3}A ﬁ\t{SPACE}":
            raise ValueError("only models that keep texts as they are, behind a space, are supported")
        size = model.get_piece_size()
        self.bos, self.eos, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        self.bytes_ids = [None] * 256
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.raw: list[bytes] = []
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                self.bytes_ids[int(piece[3:5], 16)] = i
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.raw.append(b"")
            elif model.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.score[piece] = model.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.by_segment = all(
            not re.search(f"[^{SPACE}]{SPACE}", p) and (len(p) == 1 or "\n" not in p) for p in self.ids
        )
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [piece]:  # others can't come out of merges
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The merges carried out one by one: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side encode to themselves; remembered."""
        one, other = self.pieces[left], self.pieces[right]
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        found = self.pairs[left * len(self.pieces) + right] = self.merged(one + other) == [one, other]
        return found

    def prefix_table(self, segment: str) -> list[int]:
        """The last token of every prefix by its length, -1 for a character outside
        the vocabulary, which stands alone and merges with nothing."""
        last = [-1] * (len(segment) + 1)
        known, size = self.pairs.get, len(self.pieces)
        for at, (token, length) in self.automaton.iter(segment):
            end = at + 1
            if last[end] >= 0:
                continue  # found already, and there is only one
            start = end - length
            before = last[start]
            if start and before >= 0:
                fits = known(before * size + token)
                if not (self.compatible(before, token) if fits is None else fits):
                    continue
            last[end] = token
        return last

    def tokens(self, segment: str) -> list[str]:
        """The segment's tokens, read off the table from the end."""
        last, n = self.prefix_table(segment), len(segment)
        found = []
        while n:
            token = self.pieces[last[n]] if last[n] >= 0 else segment[n - 1]
            if last[n] < 0 and token in self.ids:
                raise AssertionError(f"no token fits the prefix that ends with {token!r}")
            found.append(token)
            n -= len(token)
        return found[::-1]

    def segment_bytes(self, segment: str) -> bytes:
        ids = array("I")
        for token in self.tokens(segment):
            if token in self.ids:
                ids.append(self.ids[token])
            else:
                ids.extend(self.unknown if i is None else i for i in (self.bytes_ids[b] for b in token.encode()))
        raw = ids.tobytes()
        if len(segment) <= REMEMBERED_LENGTH:
            if len(self.known) >= REMEMBERED_SEGMENTS:
                self.known.clear()
            self.known[segment] = raw
        return raw

    def encode(self, text: str) -> bytes:
        """The ids between begin and end, as unsigned 32-bit integers of this machine."""
        inner = b""
        if text:
            marked = SPACE + text.replace(" ", SPACE)
            segments = SEGMENTS.findall(marked) if self.by_segment else [marked]
            known, fresh = self.known.get, self.segment_bytes
            inner = b"".join([known(s) or fresh(s) for s in segments])
        return array("I", [self.bos]).tobytes() + inner + array("I", [self.eos]).tobytes()

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.raw.__getitem__, memoryview(ids).cast("I")))
        text = raw.decode("utf-8", "one_mark_per_byte")
        return text[1:] if text.startswith(" ") else text


def _one_mark_per_byte(error):
    return "�" * (error.end - error.start), error.end


def load(path: str) -> Pieces:
    return kept_by_worker(f"pieces {path}", lambda: Pieces(path))


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) of every whole text.

    ``ids`` are little-endian unsigned 32-bit integers; without ``keep`` they are
    left out, for those who want digests alone."""

    bounded_batches(docs.sparkSession)
    def run(batches):
        import sys

        import pyarrow as pa

        pieces = load(path)
        for batch in batches:
            sizes, ids, id_digests, text_digests = [], [], [], []
            for text in batch.column(1):
                found = pieces.encode(text.as_py())
                back = pieces.decode(found)
                if sys.byteorder == "big":
                    swapped = array("I", found)
                    swapped.byteswap()
                    found = swapped.tobytes()
                sizes.append(len(found) // 4)
                if keep:
                    ids.append(found)
                id_digests.append(hashlib.sha256(found).hexdigest())
                text_digests.append(hashlib.sha256(back.encode()).hexdigest())
            columns = {"doc_id": batch.column(0), "n_tokens": pa.array(sizes, pa.int64())}
            if keep:
                columns["ids"] = pa.array(ids, pa.binary())
            columns |= {"ids_sha256": pa.array(id_digests, pa.string()), "decoded_sha256": pa.array(text_digests, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)
        # A worker lives on after the task; pairs are few and stay, segments are many.
        pieces.known.clear()

    given = docs.select(docs[id_col].cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    kept = "ids binary, " if keep else ""
    return given.mapInArrow(run, f"doc_id long, n_tokens long, {kept}ids_sha256 string, decoded_sha256 string")
