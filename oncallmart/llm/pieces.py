"""SentencePiece ids of whole texts by a table of last tokens, and texts from ids.

The model is of the merge kind: of all neighbouring symbols whose join is a piece, the pair
with the best score is joined first, the leftmost among equals. Two facts make a table of
prefixes enough. A row of pieces is what the merges give if and only if each two neighbours
alone are; and each prefix has one such row. So the table stores the last piece of every
prefix: an automaton names the pieces that end at a place, the longest first, and the one
that agrees with the last piece before it is stored. The ids are then read backwards.

Whether a pair agrees follows from the borders alone: the left piece's ends and the right
piece's beginnings, from single characters up, as the merges made them. A join across the
border must not come before the joins that used up its two sides.

Texts are cut only where no piece can reach across, and what is between is worked out once
and remembered. Characters without a piece become their bytes' pieces. Models of another
kind, with a character map, pieces of the user, or pieces that are better than their own
parts are refused by `ValueError`.

A null text counts as empty: the begin and end ids alone. Every row gives one row, repeated
ones too; a null doc_id is kept; further columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array

import ahocorasick
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.llm import words as W

SPACE = "▁"
# Fixed values of the model format: kinds of a piece, kind of the model.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2
# So many short stretches, and so many pairs of pieces, are remembered.
REMEMBERED = 200_000
SLICE = 500


def fields(message: bytes):
    """Number and value of each field of a protocol message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, message[at : at + size]
            at += size


def read_model(raw: bytes):
    """Pieces as (text, score, kind) in order of their ids, and the specifications of the
    trainer and the normalizer as dicts by field number."""
    found, trainer, normalizer = [], {}, {}
    for number, value in fields(raw):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            found.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normalizer = dict(fields(value))
    return found, trainer, normalizer


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, raw: bytes):
        found, trainer, normalizer = read_model(raw)
        # Absent flags of the format are on: prefix, removal of spaces, escape of spaces.
        if trainer.get(3, 1) != MERGES or normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1):
            raise ValueError("only merge models without a character map that keep all spaces")
        if not trainer.get(35) or {k for _, _, k in found} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("only models with byte pieces and without pieces of the user")
        if trainer.get(24):
            raise ValueError("only models with spaces before words")
        self.prefix = SPACE if normalizer.get(3, 1) else ""
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.shown = [p.replace(SPACE, " ").encode() for p, _, _ in found]
        self.bytes_of: dict[int, int] = {}
        self.control = {k for k, (_, _, kind) in enumerate(found) if kind == CONTROL}
        self.piece: dict[str, int] = {}
        self.score: list[float] = []
        for k, (text, score, kind) in enumerate(found):
            self.score.append(score)
            if kind == BYTE:
                value = int(text[3:5], 16)
                self.bytes_of[value] = k
                self.shown[k] = bytes([value])
            elif kind == NORMAL:
                self.piece.setdefault(text, k)
            else:
                self.shown[k] = b"" if kind == CONTROL else " ⁇ ".encode()
        if len(self.bytes_of) != 256:
            raise ValueError("a piece for every byte is needed")
        self._learn_joins()
        self._cut_rule()
        # Pieces whose space is left out where a text begins.
        self.spaced = {k for t, k in self.piece.items() if t.startswith(SPACE) and self.prefix}
        self.known = W.Remembered(self.stretch, REMEMBERED)
        self.agreed = W.Remembered(lambda pair: self.agree(*pair), REMEMBERED)

    def _learn_joins(self) -> None:
        """The one last join of each piece, from the best score down; `ends[p]` and `starts[p]`
        hold a piece's (part, score of the join that uses the part up) along its border."""
        never = float("-inf")
        self.join: dict[tuple[int, int], float] = {}
        self.ends: dict[int, list[tuple[int, float]]] = {}
        self.starts: dict[int, list[tuple[int, float]]] = {}
        for text, k in self.piece.items():
            if len(text) == 1:
                self.ends[k] = self.starts[k] = [(k, never)]
        order = sorted(
            ((t, k) for t, k in self.piece.items() if len(t) > 1),
            key=lambda x: (-self.score[x[1]], len(x[0])),
        )
        for text, k in order:
            score = self.score[k]
            for cut in range(1, len(text)):
                a, b = self.piece.get(text[:cut]), self.piece.get(text[cut:])
                if a in self.ends and b in self.starts and self.agree(a, b):
                    self.join[a, b] = score
                    self.ends[k] = [(k, never), (b, score), *self.ends[b][1:]]
                    self.starts[k] = [(k, never), (a, score), *self.starts[a][1:]]
                    break
            else:
                if merged(text, {t: self.score[p] for t, p in self.piece.items()}) == [text]:
                    raise ValueError(f"piece {k} is better than its own parts")
        automaton = ahocorasick.Automaton()
        for text, k in self.piece.items():
            if k in self.ends:
                automaton.add_word(text, (k, len(text)))
        if self.ends:
            automaton.make_automaton()
        self.automaton = automaton

    def agree(self, a: int, b: int) -> bool:
        """Whether the merges leave piece `a` followed by piece `b` as they are. Of equal joins
        the left one is first: those inside `a` before, those inside `b` after the border's."""
        join = self.join
        for x, used_x in self.ends[a]:
            for y, used_y in self.starts[b]:
                score = join.get((x, y))
                if score is not None and score > used_x and score >= used_y:
                    return False
        return True

    def _cut_rule(self) -> None:
        longer = [t for t in self.piece if len(t) > 1]
        joined = "".join(sorted(set("".join(longer)) - {SPACE}))
        inner = f"[{re.escape(joined)}]" if joined else "(?!)"
        if any(SPACE in t.lstrip(SPACE) for t in longer):
            inner = f"(?:{SPACE}|{inner})"
            self.cut = re.compile(f"{inner}+|.", re.DOTALL)
        else:
            self.cut = re.compile(f"{SPACE}+{inner}*|{inner}+|.", re.DOTALL)

    def stretch(self, text: str) -> bytes:
        """Ids of a stretch as little-endian 32-bit bytes, by the table of last pieces."""
        n = len(text)
        last: list[tuple[int, int] | None] = [None] * (n + 1)
        agreed = self.agreed
        for end, (k, size) in self.automaton.iter(text) if self.ends else ():
            end += 1
            if last[end] is None:
                before = last[end - size]
                # No piece ends before: the text's begin or a character without a piece.
                if before is None or agreed[before[0], k]:
                    last[end] = (k, size)
        ids, at = [], n
        while at:
            if last[at] is None:
                ids.extend(self.bytes_of[x] for x in reversed(text[at - 1].encode()))
                at -= 1
            else:
                k, size = last[at]
                ids.append(k)
                at -= size
        return array("I", reversed(ids)).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Ids with the begin and end ids, as little-endian 32-bit bytes."""
        text = text or ""
        inner = b""
        if text:
            escaped = self.prefix + text.replace(" ", SPACE)
            inner = b"".join(map(self.known.__getitem__, self.cut.findall(escaped)))
        return array("I", [self.begin]).tobytes() + inner + array("I", [self.end]).tobytes()

    def decode(self, ids: bytes | None) -> str:
        """The text of ids. A byte's piece that is part of no whole character becomes U+FFFD; the
        space that stands before every text is left out."""
        numbers = array("I", ids or b"")
        shown = self.shown
        raw = [shown[k] for k in numbers]
        # Control ids show nothing, so the text begins after them.
        first = next((at for at, x in enumerate(raw) if x), None)
        if first is not None and numbers[first] in self.spaced:
            raw[first] = raw[first][1:]
        inside = numbers[1:-1]
        if any(inside.count(k) for k in self.control):
            # Bytes on two sides of a control id are no character together.
            cuts = [-1, *(at for at, k in enumerate(numbers) if k in self.control), len(raw)]
            runs = [b"".join(raw[a + 1 : b]) for a, b in zip(cuts, cuts[1:])]
        else:
            runs = [b"".join(raw)]
        return "".join([x.decode(errors="each_byte") for x in runs])


# UTF-8 with U+FFFD for each byte that begins no whole character.
codecs.register_error("each_byte", lambda bad: ("\ufffd", bad.start + 1))


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces of a short text by the merges themselves."""
    row = list(text)
    while True:
        best = max(
            ((scores[row[i] + row[i + 1]], -i) for i in range(len(row) - 1) if row[i] + row[i + 1] in scores),
            default=None,
        )
        if best is None:
            return row
        i = -best[1]
        row[i : i + 2] = [row[i] + row[i + 1]]


_loaded: dict[str, Pieces] = {}


def pieces_by(file: str) -> Pieces:
    """The model of a file and what it remembers, kept for a worker's next tasks."""
    if file not in _loaded:
        with open(file, "rb") as source:
            _loaded[file] = Pieces(source.read())
    return _loaded[file]


def default_file() -> str:
    return public_tokenizers.path("piece_bpe_32k.model")


def _map(frame: DataFrame, file: str, ids: bool, text: bool) -> DataFrame:
    names = ["doc_id", *["ids"] * ids, *["decoded"] * text]
    source = frame.schema.names[1]

    def work(batches):
        model = pieces_by(file)
        for batch in batches:
            for begin in range(0, len(batch), SLICE):
                part = batch.slice(begin, SLICE)
                columns = [part.column(0)]
                rows = part.column(1).to_pylist()
                if source == "text":
                    rows = [model.encode(t) for t in rows]
                if ids:
                    columns.append(pa.array(rows, pa.binary()))
                if text:
                    columns.append(pa.array([model.decode(x) for x in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = {"doc_id": frame.schema[0].dataType.simpleString(), "ids": "binary", "decoded": "string"}
    return frame.mapInArrow(work, ", ".join(f"{n} {kinds[n]}" for n in names))


def encode(docs: DataFrame, file: str | None = None) -> DataFrame:
    """(doc_id, ids): ids of `text` as little-endian unsigned 32-bit bytes."""
    return _map(docs.select("doc_id", "text"), file or default_file(), True, False)


def decode(coded: DataFrame, file: str | None = None) -> DataFrame:
    """(doc_id, decoded): the text of each row of `ids`."""
    return _map(coded.select("doc_id", "ids"), file or default_file(), False, True)


def encode_decode(docs: DataFrame, file: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded): both in one pass over the texts."""
    return _map(docs.select("doc_id", "text"), file or default_file(), True, True)


def digests(docs: DataFrame, file: str | None = None) -> DataFrame:
    """Per document the number of ids and the digests of its ids and of the decoded text."""
    return encode_decode(docs, file).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
