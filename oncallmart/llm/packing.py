"""Packing of tokenized documents into sequences by bin completion.

A document's ids are cut into pieces of at most 4096; only the last may be shorter. Pieces
are dealt to blocks of bounded size by a hash of their row, and each block is packed alone:
around its largest piece, the fillings of the free room that no other filling dominates are
enumerated, the least waste first; a best-fit packing of the block is the incumbent, and the
packing with fewer sequences stays. Among the last pieces of a block, where waste arises,
the search branches over fillings and prunes by the waste that a better packing may have.
Sequences that are full are final; the pieces of the others meet in fewer blocks in the
next round, until they fit in one block or no longer shrink by a quarter.

A null or empty text is one piece with the closing id alone. Repeated rows and doc_ids are
packed one by one; a null doc_id is kept. Further columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.llm import words as W
from oncallmart.session import settle

ROOM = 4096
CLOSING = 1
BLOCK = 4000
# Nodes that the search for one sequence's filling, and for a block's last pieces, may visit.
FILL_NODES, TAIL_NODES, TAIL = 400, 4000, 40
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = f"{PIECES}, row bigint, sequence_id bigint, offset bigint, full boolean"
# Fixed values, as the tokenizer file has them: how it cuts a word, here for words of ASCII and
# lower-case Latin-1 letters only; the characters that stand for bytes by themselves.
PLAIN = re.compile(r"[!-@\[-~ß-öø-ÿ]+")
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
# All other bytes stand as the characters from 256 on, in order.
SHOWN = {x: chr(x) for x in PRINTED} | {
    x: chr(256 + k) for k, x in enumerate(x for x in range(256) if x not in PRINTED)
}


class Ids:
    """Ids of texts as little-endian 32-bit bytes, word by word.

    The tokenizer drops white space and treats words apart, so a word's ids are worked out
    once and remembered. A plain word is cut as the tokenizer would, and its parts go to the
    merges directly; any other word goes through the whole tokenizer.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.parts = W.Remembered(self.part, 200_000)
        self.words = W.Remembered(self.word, 200_000)

    def part(self, text: str) -> bytes:
        shown = text.encode().decode("latin-1").translate(SHOWN)
        return array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join([self.parts[x] for x in CUT.findall(text)])
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        closing, out = array("I", [CLOSING]).tobytes(), []
        for text in texts:
            text = text or b""
            # A special token's text is told by its case, so a text with one keeps its own.
            words = (text if b"<|" in text else text.lower()).split()
            out.append(b"".join(map(self.words.__getitem__, words)) + closing)
        return out


_loaded: dict[str, Ids] = {}


def ids_by(file: str) -> Ids:
    """The tokenizer of a file and what it remembers, kept for a worker's next tasks."""
    if file not in _loaded:
        _loaded[file] = Ids(file)
    return _loaded[file]


def cut(file: str):
    def work(batches):
        ids_of = ids_by(file)
        for batch in batches:
            for begin in range(0, len(batch), 500):
                part = batch.slice(begin, 500)
                rows = []
                doc_ids = part.column("doc_id").to_pylist()
                for doc_id, ids in zip(doc_ids, ids_of(W.as_bytes(part.column("text"))), strict=True):
                    for k, at in enumerate(range(0, len(ids), 4 * ROOM)):
                        piece = ids[at : at + 4 * ROOM]
                        rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
                columns = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return work


class Lengths:
    """Multiset of lengths with the distinct ones in order."""

    def __init__(self, lengths):
        values, counts = np.unique(np.asarray(lengths, np.int64), return_counts=True)
        self.order = values.tolist()
        self.count = dict(zip(self.order, counts.tolist(), strict=True))

    def take(self, x: int) -> None:
        self.count[x] -= 1
        if not self.count[x]:
            del self.count[x]
            del self.order[bisect_right(self.order, x) - 1]

    def give(self, x: int) -> None:
        if x not in self.count:
            insort(self.order, x)
            self.count[x] = 0
        self.count[x] += 1

    def upto(self, x: int) -> int:
        """Place after the largest length that is at most x."""
        return bisect_right(self.order, x)


def fillings(have: Lengths, room: int, nodes: int) -> list[list[int]]:
    """Undominated fillings of `room`, the least waste first. Lengths are tried in falling
    order, each as often as it fits first; one that fits exactly dominates every set in its
    place, and a filling that leaves room for another piece is dominated by the one with it."""
    found: list[tuple[int, int, list[int]]] = []
    left = nodes
    chosen: dict[int, int] = {}

    def note(room: int) -> None:
        found.append((room, sum(chosen.values()), [x for x, q in chosen.items() for _ in range(q)]))

    def search(room: int, below: int) -> bool:
        nonlocal left
        left -= 1
        fitting = have.upto(room)
        if not any(have.count[x] > chosen.get(x, 0) for x in have.order[:fitting]):
            note(room)
            return room == 0
        below = min(below, fitting)
        if below and have.order[below - 1] == room:
            chosen[room] = 1
            note(0)
            del chosen[room]
            return True
        for k in range(below - 1, -1, -1):
            x = have.order[k]
            for times in range(min(have.count[x], room // x), 0, -1):
                if left <= 0 and found:
                    return False
                chosen[x] = times
                full = search(room - x * times, k)
                del chosen[x]
                if full:
                    return True
        return False

    search(room, len(have.order))
    return [f for _, _, f in sorted(found, key=lambda x: x[:2])]


def best_fit(lengths: list[int]) -> list[list[int]]:
    """Best-fit decreasing: the fullest sequence that still has room takes the next length."""
    free: list[tuple[int, int]] = []
    out: list[list[int]] = []
    for x in sorted(lengths, reverse=True):
        k = bisect_right(free, (x, -1))
        if k < len(free):
            room, at = free.pop(k)
        else:
            room, at = ROOM, len(out)
            out.append([])
        out[at].append(x)
        insort(free, (room - x, at))
    return out


def branch(lengths: list[int], nodes: int = TAIL_NODES) -> list[list[int]]:
    """Branch and bound over fillings for a few lengths; the incumbent is best fit."""
    best = best_fit(lengths)
    total = sum(lengths)
    least = -(-total // ROOM)
    have = Lengths(lengths)
    path: list[list[int]] = []

    def search(waste: int) -> None:
        nonlocal best, nodes
        nodes -= 1
        if not have.order:
            if len(path) < len(best):
                best = [list(x) for x in path]
            return
        # A better packing has one sequence less, so this much waste at most.
        if nodes <= 0 or len(best) == least or waste > (len(best) - 1) * ROOM - total:
            return
        largest = have.order[-1]
        have.take(largest)
        for filling in fillings(have, ROOM - largest, 50)[:4]:
            for x in filling:
                have.take(x)
            path.append([largest, *filling])
            search(waste + ROOM - largest - sum(filling))
            path.pop()
            for x in filling:
                have.give(x)
        have.give(largest)

    search(0)
    return best


def pack(lengths: list[int]) -> list[list[int]]:
    """Sequences of lengths, as few as the search finds."""
    have, out, left = Lengths(lengths), [], len(lengths)
    while left > TAIL:
        largest = have.order[-1]
        have.take(largest)
        filling = fillings(have, ROOM - largest, FILL_NODES)[0]
        for x in filling:
            have.take(x)
        out.append([largest, *filling])
        left -= 1 + len(filling)
    out += branch([x for x in have.order for _ in range(have.count[x])])
    greedy = best_fit(lengths)
    return greedy if len(greedy) < len(out) else out


def pack_block(block: pa.Table) -> pa.Table:
    lengths = block.column("length").to_numpy()
    order = np.argsort(-lengths, kind="stable")
    waiting: dict[int, list[int]] = {}
    for k in order[::-1].tolist():
        waiting.setdefault(int(lengths[k]), []).append(k)
    number = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    full = np.zeros(len(lengths), bool)
    base = int(block.column("base")[0].as_py())
    for k, members in enumerate(pack(lengths.tolist())):
        at, whole = 0, sum(members) == ROOM
        for x in members:
            row = waiting[x].pop()
            number[row], offset[row], full[row] = base + k, at, whole
            at += x
    kept = block.select(["doc_id", "piece", "start", "length", "ids_crc32", "row"])
    return (
        kept.append_column("sequence_id", pa.array(number))
        .append_column("offset", pa.array(offset))
        .append_column("full", pa.array(full))
    )


def pieces(documents: DataFrame, file: str | None = None) -> DataFrame:
    """The pieces of every document, stored, each with a row number."""
    file = file or public_tokenizers.path("word_bpe_49k.json")
    made = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut(file), PIECES)
    # Row numbers stay what they are because the rows are stored with them.
    return settle(made.withColumn("row", F.monotonically_increasing_id()))


def pack_documents(documents: DataFrame, file: str | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    todo = pieces(documents, file)
    rows, turn, done = todo.count(), 0, []
    while True:
        blocks = max(1, -(-rows // block))
        dealt = todo.withColumn("block", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(blocks))).withColumn(
            "base", F.shiftleft(F.lit(turn).cast("bigint"), 56) + F.shiftleft("block", 16)
        )
        placed = settle(dealt.groupBy("block").applyInArrow(pack_block, PLACED))
        left = placed.where("not full")
        before, rows, turn = rows, left.count(), turn + 1
        if blocks == 1 or rows * 4 > before * 3:
            done.append(placed)
            break
        done.append(placed.where("full"))
        todo = left.drop("sequence_id", "offset", "full")
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select(columns)
