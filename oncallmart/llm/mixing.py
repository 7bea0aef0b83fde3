"""Language-model scores by online logistic context mixing.

A text is coded bit by bit, its tokens' closing bytes included. For every bit, five hashed
contexts (the last 1, 2, 3, 4 and 6 bytes of the text, across the borders of tokens; before a text
are spaces) each predict from the zeros and ones that followed them in all training texts. Their log-odds are combined by weights
that a gate selects (the place in the token and in the byte, and how many contexts are known). The weights are refined online
over the training texts of a block: after every few texts they move against their coding error, where each byte is
predicted from the counts of all others. What a block has learnt codes its texts. A token's
spelling after the bytes before it is mixed with the token's frequency
after the word before it (or the start of the text), in all training texts, and in those of
the text's class (one of eight, by its bytes, whose cost is part of the score). How often the
word before was seen selects the weights. They start from expectation-maximisation on the
vocabulary and are refined online over the token streams of all training texts, each token
predicted from all others before it moves them; a block of texts does so on its own and scores
with what it has learnt. Every part sums to one over all tokens, so the result is a probability
of the whole text.

A bit's prediction depends on its byte and the six before it alone, so a block works out each
distinct run of seven bytes once and counts how often it occurs: nothing of a text is left out.

Counts cover every training text and grow with the corpus; nothing of it is sent whole to one
task. Documents stay where they are read, in blocks of about 12 MB of text; a block numbers its
distinct tokens and pairs of neighbours once and keeps documents as numbers. Tokens and pairs
(48-bit hashes) are packed by ranges of their hash; a range is summed over all blocks by the
tokens themselves, and only counts and spellings return to the block. What was read for the
last time is deleted. The table of the hashed counts has a fixed size, its counts 16 bits: where
more followed a context, zeros and ones shrink alike.

A null text counts as empty: its one token is the end. Repeated rows are scored each and, in
training, counted each; a null doc_id is training. Further columns are ignored; an empty table
gives an empty result. Without training tokens the frequencies have no weight.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.llm.stored import discard_stored, stored
from oncallmart.llm.words import FACTORS, as_bytes, mix, split

BLOCK_BYTES = 12_000_000
ORDERS = (1, 2, 3, 4, 6)
SLOT_BITS = 21
SLOTS = 1 << SLOT_BITS
PRIOR, STEEPEST, RATE, HOLD, ALWAYS = 0.3, 8.0, 1.0, 50.0, 0.3
# Bytes before a byte that its contexts reach, and its own place in a run of bytes.
REACH, OWN = ORDERS[-1], np.uint64(8 * ORDERS[-1])
# One set of weights for each place in the token (the last for all later ones), number of
# predictors that know the context, and bit of a byte.
PLACES, KNOWN = REACH + 1, len(ORDERS) + 1
GATES = PLACES * KNOWN * 8
# Tokens of one online step over a stream, bytes whose runs are counted together, and runs worked
# on together: their arrays stay in a core's cache.
STEP, GATHER, PIECE = 2000, 1_000_000, 1 << 16
CLOSE = 0x20
# Slots of one row of context counts, and tasks whose rows meet first.
CHUNK, MEET = 1 << 16, 64
# Texts numbered together; a block ends after one of these.
SLICE = 200
# Classes of texts, and the training documents that start them.
CLASSES, START = 8, 256
# Sets of weights of a token's sources, by how often the word before was seen (powers of four);
# the online steps count the weights that they start from as so many tokens of a set. A step has
# so many texts, and the first is repeated so often to warm up.
BEFORE, TRUST, TEXTS, WARM = 12, 100, 500, 1
# Bits of a token's or pair's hash, and bytes of it, of a token's number and of a count when stored.
HASH_BITS, HASH_BYTES, ID_BYTES, COUNT_BYTES = 48, 6, 4, 6
# The word before a text's first token is none.
SEED, NONE = 42, np.uint64(0x9E3779B97F4A7C15)
NAMES = ["part", "block", "doc_id", "held_out", "kind", "ids", "bytes", "tokens", "kinds", "pairs", "seen"]
PARTS = (
    "part string, block bigint, doc_id bigint, held_out boolean, kind int, ids binary, bytes bigint, tokens binary, "
    "kinds binary, pairs binary, seen binary"
)
VOCABULARY = "part string, block bigint, kind int, tokens binary, kinds binary, ids binary, seen binary"
TYPES = [
    pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary(),
    pa.binary(),
]
RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double, bits_per_byte double"
)


class Numbers(dict):
    """Number of a token of one class, in order of appearance in the block."""

    def __init__(self, kind: int, listed: list[bytes], kinds: bytearray, hashes: array):
        super().__init__()
        self.kind, self.listed, self.kinds, self.hashes = kind, listed, kinds, hashes

    def __missing__(self, token):
        number = self[token] = len(self.listed)
        self.listed.append(token)
        self.kinds.append(self.kind)
        self.hashes.append(xxhash.xxh64_intdigest(token, seed=SEED) >> 64 - HASH_BITS)
        return number


def pair_hashes(hashes: np.ndarray, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Number of each token with the one before it; `start` has the places of first tokens."""
    own = hashes[ids]
    before = np.empty_like(own)
    before[1:] = own[:-1]
    before[start] = NONE
    return mix(before * np.uint64(FACTORS[0]) + own * np.uint64(FACTORS[1])) >> np.uint64(64 - HASH_BITS)


def planes(x: np.ndarray, width: int) -> bytes:
    """Whole numbers as their lowest bytes, then the next ones: what is alike lies together."""
    return np.ascontiguousarray(x).astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def distinct(x: np.ndarray) -> np.ndarray:
    """Distinct numbers in order. Sorting is several times as fast as the hash table of `np.unique`."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and the place of each number among them."""
    order = np.argsort(x)
    of, ordered = np.empty(len(x), np.int32), x[order]
    new = np.append(True, ordered[1:] != ordered[:-1])[: len(x)]
    of[order] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], of


def ranks(x: np.ndarray) -> tuple[np.ndarray, int]:
    """Place of each number among the distinct ones, and how many these are."""
    found, of = numbered(x)
    return of, len(found)


def range_starts(ranges: int) -> np.ndarray:
    """First hash of each of equal ranges."""
    return np.arange(ranges, dtype=np.uint64) * np.uint64((1 << HASH_BITS) // ranges)


def profile(text: bytes | None) -> np.ndarray:
    """Square roots of the shares of the bytes of the lower-cased text."""
    counts = np.bincount(np.frombuffer((text or b"").lower(), np.uint8), minlength=256)
    return np.sqrt(counts / max(counts.sum(), 1))


def nearest(profiles: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * profiles @ centres.T).argmin(axis=1)


def first_centres(profiles: np.ndarray) -> np.ndarray:
    """Centres of the starting documents: the best of some short runs."""
    best, least = np.zeros((CLASSES, 256)), np.inf
    for seed in range(8 if len(profiles) else 0):
        dice = np.random.default_rng(seed)
        centres = profiles[dice.integers(0, len(profiles), CLASSES)]
        for _ in range(8):
            of = nearest(profiles, centres)
            centres = np.stack([profiles[of == k].mean(axis=0) if (of == k).any() else centres[k] for k in range(CLASSES)])
        far = ((profiles - centres[nearest(profiles, centres)]) ** 2).sum()
        if far < least:
            best, least = centres, far
    return best


def _profiles(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [pa.array([profile(t).tolist() for t in as_bytes(batch.column("text"))], pa.list_(pa.float64()))], names=["profile"]
        )


def _class_sums(centres: np.ndarray):
    def work(batches):
        sums = np.zeros((CLASSES, 257))
        for batch in batches:
            profiles = np.array([profile(t) for t in as_bytes(batch.column("text"))]).reshape(-1, 256)
            of = nearest(profiles, centres)
            for k in range(CLASSES):
                sums[k, :256] += profiles[of == k].sum(axis=0)
                sums[k, 256] += (of == k).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(sums.size, dtype=np.int32)), pa.array(sums.ravel())], names=["place", "total"]
        )

    return work


def text_classes(training: DataFrame, passes: int = 2) -> np.ndarray:
    """Centres of text classes by their bytes. A few documents start them; passes over all
    training texts move them, and only sums of fixed size come back."""
    # Ids are chosen first, so that no task gathers texts; repeated ids are bounded again.
    ids = training.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(START)
    start = (
        training.join(F.broadcast(ids.distinct()), "doc_id", "left_semi")
        .mapInArrow(_profiles, "profile array<double>").limit(START).collect()
    )
    centres = first_centres(np.array([r.profile for r in start]).reshape(-1, 256))
    for _ in range(passes):
        rows = training.mapInArrow(_class_sums(centres), "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).collect()
        sums = np.zeros(CLASSES * 257)
        for r in rows:
            sums[r.place] = r.total
        sums = sums.reshape(CLASSES, 257)
        filled = sums[:, 256] > 0
        centres = np.where(filled[:, None], sums[:, :256] / np.maximum(sums[:, 256:], 1), centres)
    return centres


def _filled(n: int, **columns) -> pa.RecordBatch:
    """Rows of PARTS with some columns; the others are null."""
    types = dict(zip(NAMES, TYPES, strict=True))
    columns = {x: c if isinstance(c, pa.Array) else pa.array(c, types[x]) for x, c in columns.items()}
    arrays = [columns[x] if x in columns else pa.nulls(n, types[x]) for x in NAMES]
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


class Numbering:
    """Tokens, training counts and pairs of neighbours of one block while it is read."""

    def __init__(self, block: int, centres: np.ndarray):
        self.block, self.centres, self.bytes = block, centres, 0
        self.listed, self.kinds, self.hashes = [], bytearray(), array("Q")
        self.numbers = [Numbers(k, self.listed, self.kinds, self.hashes) for k in range(CLASSES)]
        self.counts = np.zeros(1 << 12, np.int64)
        self.trained, self.asked = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        self.runs, self.waiting = [], []

    def _widen(self) -> None:
        if len(self.listed) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(len(self.listed), np.int64)])

    def documents(self, part: pa.RecordBatch) -> pa.RecordBatch:
        """Documents as token numbers. The end of a text is the empty token."""
        held = np.array(part.column("held_out").to_pylist(), bool)
        texts = as_bytes(part.column("text"))
        kinds = nearest(np.array([profile(t) for t in texts]), self.centres)
        rows = []
        for text, kind, out in zip(texts, kinds.tolist(), held.tolist(), strict=True):
            tokens = split(text)
            tokens.append(b"")
            if not out:
                self.waiting.append(b" ".join(tokens) + b" ")
            rows.append(np.fromiter(map(self.numbers[kind].__getitem__, tokens), np.int64, len(tokens)))
        lengths = np.array([len(r) for r in rows], np.int64)
        flat, training = np.concatenate(rows), np.repeat(~held, lengths)
        self._widen()
        found = np.bincount(flat[training])
        self.counts[: len(found)] += found
        pairs = pair_hashes(np.array(self.hashes), flat, np.cumsum(lengths) - lengths)
        self.trained.append(pairs[training])
        self.asked.append(distinct(pairs[~training]))
        sizes = [len(t or b"") for t in texts]
        self.bytes += sum(sizes)
        if sum(map(len, self.waiting)) >= GATHER:
            self._gather()
        n = len(part)
        return _filled(
            n, part=["documents"] * n, block=[self.block] * n, doc_id=part.column("doc_id"), held_out=part.column("held_out"),
            kind=kinds, ids=[planes(r, ID_BYTES) for r in rows], bytes=sizes,
        )

    def _gather(self) -> None:
        self.runs.append(occurrences(grams(self.waiting)))
        self.waiting = []

    def count(self, counts: np.ndarray) -> None:
        """What follows the contexts of the block's training texts joins the counts of the task."""
        self._gather()
        add_grams(counts, *merged(*(np.concatenate(x) for x in zip(*self.runs, strict=True))))
        self.runs = []

    def tokens(self, ranges: int):
        """Tokens by ranges of their hash, in the order of their numbers."""
        self._widen()
        hashes, kinds = np.array(self.hashes), np.frombuffer(bytes(self.kinds), np.uint8)
        of = np.searchsorted(range_starts(ranges), hashes, "right") - 1
        order = np.argsort(of, kind="stable")
        filled, starts = np.unique(of[order], return_index=True)
        cuts = np.append(starts, len(order))
        for begin in range(0, len(filled), 32):
            at = [order[cuts[k] : cuts[k + 1]] for k in range(begin, min(begin + 32, len(filled)))]
            n = len(at)
            yield _filled(
                n, part=["tokens"] * n, block=[self.block] * n, kind=filled[begin : begin + n],
                tokens=[b" ".join([self.listed[i] for i in a.tolist()]) for a in at], kinds=[kinds[a].tobytes() for a in at],
                ids=[planes(a, ID_BYTES) for a in at], pairs=[planes(hashes[a], HASH_BYTES) for a in at],
                seen=[planes(self.counts[a], COUNT_BYTES) for a in at],
            )

    def pairs(self, ranges: int):
        """Distinct pairs with their training counts by ranges of their hash."""
        pairs, seen = np.unique(np.concatenate(self.trained), return_counts=True)
        asked = distinct(np.concatenate(self.asked))
        more = asked[~np.isin(asked, pairs, assume_unique=True)]
        order = np.argsort(both := np.concatenate([pairs, more]))
        pairs, seen = both[order], np.concatenate([seen, np.zeros(len(more), np.int64)])[order]
        filled, starts = np.unique(np.searchsorted(range_starts(ranges), pairs, "right") - 1, return_index=True)
        cuts = np.append(starts, len(pairs))
        for begin in range(0, len(filled), 32):
            cut = [slice(cuts[k], cuts[k + 1]) for k in range(begin, min(begin + 32, len(filled)))]
            n = len(cut)
            yield _filled(
                n, part=["pairs"] * n, block=[self.block] * n, kind=filled[begin : begin + n],
                pairs=[planes(pairs[c], HASH_BYTES) for c in cut], seen=[planes(seen[c], COUNT_BYTES) for c in cut],
            )


def _blocks(centres: np.ndarray, ranges: int, block_bytes: int):
    """A task's documents in blocks, each followed by its tokens and its pairs. Documents stay
    in the task that read them."""

    def work(batches):
        task = TaskContext.get().partitionId()
        block, own, counts = 0, None, np.zeros((2, len(ORDERS) * SLOTS), np.uint32)

        def ended():
            own.count(counts)
            yield from own.tokens(ranges)
            yield from own.pairs(ranges)

        for batch in batches:
            for begin in range(0, len(batch), SLICE):
                own = own or Numbering((task << 32) + block, centres)
                yield own.documents(batch.slice(begin, SLICE))
                if own.bytes >= block_bytes:
                    yield from ended()
                    block, own = block + 1, None
        if own:
            yield from ended()
        for begin in range(0, counts.shape[1], CHUNK):
            part = counts[:, begin : begin + CHUNK]
            # The first goes always, so that there is a table to read.
            if not begin or part.any():
                yield _filled(1, part=["contexts"], block=[task // MEET], kind=[begin // CHUNK], seen=[pressed(part)])

    return work


def grams(texts: list[bytes]) -> np.ndarray:
    """For each byte of the texts one number: itself and the bytes before it, the nearest first."""
    if not texts:
        return np.empty(0, np.uint64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + REACH
    before = bytes([CLOSE]) * REACH
    data = b"\0" + b"".join([before + t for t in texts])
    # Eight bytes from every place on as one number, the last byte first; the farthest goes.
    runs = np.ndarray(len(data) - REACH - 1, "<u8", data, strides=(1,)) >> np.uint64(8)
    own = np.ones(len(runs) + REACH, bool)
    own[((np.cumsum(lengths) - lengths)[:, None] + np.arange(REACH)).ravel()] = False
    return runs[own[REACH:]]


def merged(runs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs in order, and how often each occurs in all."""
    if not len(runs):
        return runs, times
    order = np.argsort(runs)
    runs = runs[order]
    first = np.flatnonzero(np.append(True, runs[1:] != runs[:-1]))
    return runs[first], np.add.reduceat(times[order], first)


def occurrences(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    runs = np.sort(runs)
    first = np.flatnonzero(np.append(True, runs[1:] != runs[:-1])[: len(runs)])
    return runs[first], np.diff(np.append(first, len(runs)))


class Grams:
    """Distinct runs of bytes in order. Runs that agree in the byte and the last bytes of an
    order lie together, so each order's prediction is worked out once for all of them."""

    def __init__(self, runs: np.ndarray):
        self.flat, self.place = (runs >> OWN).astype(np.uint8), np.full(len(runs), PLACES - 1, np.int16)
        for back in range(REACH, 0, -1):
            self.place[(runs >> (OWN - np.uint64(8 * back))) & np.uint64(255) == CLOSE] = back - 1
        self.contexts, self.bytes, self.of = [], [], []
        for order in ORDERS:
            short = runs >> (OWN - np.uint64(8 * order))
            new = np.append(True, short[1:] != short[:-1])[: len(short)]
            short = short[new]
            self.contexts.append(mix((short & np.uint64((1 << 8 * order) - 1)) * np.uint64(FACTORS[order + 8])))
            self.bytes.append((short >> np.uint64(8 * order)).astype(np.uint8))
            self.of.append(np.cumsum(new, dtype=np.int32) - 1)

    def after(self, counts: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """One of the bytes' bits: zeros and ones after each order's contexts, and the bit."""
        found = []
        for j, (context, flat) in enumerate(zip(self.contexts, self.bytes, strict=True)):
            node, bit = bit_of(flat, k)
            found.append((*after(counts, j, context, node), bit))
        return found

    def odds(self, seen: list, k: int, without_own: bool) -> tuple[list[np.ndarray], np.ndarray]:
        """Log-odds by each order's contexts, and the gate of each run."""
        odds, gate = [], self.place * (KNOWN * 8) + k
        for (zeros, ones, bit), of in zip(seen, self.of, strict=True):
            found, there = log_odds(zeros, ones, bit if without_own else None)
            odds.append(found)
            gate += there.view(np.int8).take(of, mode="clip") * np.int8(8)
        return odds, gate

    def of_runs(self, odds: list[np.ndarray]):
        """An order's log-odds for each run, one order after the other."""
        return (found.take(of, mode="clip") for found, of in zip(odds, self.of, strict=True))


def spelling(tokens: list[bytes]):
    """Bytes of a text's tokens with their closing bytes, each byte's token and place, and the
    hashed context of each order before it."""
    runs, of = numbered(grams([b" ".join(tokens) + b" "]))
    found = Grams(runs)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    owner = np.repeat(np.arange(len(tokens)), lengths)
    return found.flat[of], owner, found.place[of], [c[o][of] for c, o in zip(found.contexts, found.of, strict=True)]


def slots_of(context: np.ndarray, node: np.ndarray) -> np.ndarray:
    x = (context + node) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def bit_of(flat: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits before one of a byte's 8 bits with a leading one, and the bit itself."""
    return (flat.astype(np.uint64) | np.uint64(256)) >> np.uint64(8 - k), (flat >> (7 - k)) & 1


def bits(flat: np.ndarray):
    """For each of a byte's 8 bits: its number, the bits before it with a leading one, itself."""
    for k in range(8):
        yield k, *bit_of(flat, k)


def add_grams(counts: np.ndarray, runs: np.ndarray, times: np.ndarray) -> None:
    """The bits of distinct runs, in order, that occur so often join the counts."""
    flat = counts.reshape(-1)
    for begin in range(0, len(runs), PIECE):
        found = Grams(runs[begin : begin + PIECE])
        for j, (context, own, of) in enumerate(zip(found.contexts, found.bytes, found.of, strict=True)):
            many = np.bincount(of, times[begin : begin + PIECE]).astype(counts.dtype)
            for _, node, bit in bits(own):
                np.add.at(flat, bit.astype(np.int64) * counts.shape[1] + j * SLOTS + slots_of(context, node), many)


def add_counts(counts: np.ndarray, tokens: list[bytes]) -> None:
    """The bits of one text, given by its tokens, join the counts."""
    add_grams(counts, *occurrences(grams([b" ".join(tokens) + b" "])))


def _vocabulary(group: pa.Table) -> pa.Table:
    """Distinct tokens of one range of hashes with their training counts in each class, and for
    each block the places of its tokens among them."""
    lists = [row.as_py().split(b" ") for row in group.column("tokens")]
    # The order of hashes, so that it follows neither the texts nor the order of the rows.
    ordered = sorted(set().union(*lists), key=lambda t: (xxhash.xxh64_intdigest(t, seed=SEED), t))
    numbers = {t: k for k, t in enumerate(ordered)}
    places = [np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens)) for tokens in lists]
    kinds = np.frombuffer(b"".join(group.column("kinds").to_pylist()), np.uint8)
    seen = np.concatenate([from_planes(x, COUNT_BYTES) for x in group.column("seen").to_pylist()])
    counts = np.bincount(kinds * np.int64(len(numbers)) + np.concatenate(places), seen, CLASSES * len(numbers)).astype(np.int64)
    n = len(group)
    return pa.table(
        {
            "part": ["answers"] * n + ["vocabulary"], "block": pa.array([*group.column("block").to_pylist(), None], pa.int64()),
            "kind": pa.array([group.column("kind")[0].as_py()] * (n + 1), pa.int32()),
            "tokens": pa.array([None] * n + [b" ".join(numbers)], pa.binary()),
            "kinds": pa.array([*group.column("kinds").to_pylist(), None], pa.binary()),
            "ids": pa.array([*(planes(p, ID_BYTES) for p in places), None], pa.binary()),
            "seen": pa.array([None] * n + [planes(counts, COUNT_BYTES)], pa.binary()),
        }
    )


def class_counts(batch: pa.RecordBatch):
    """For each range: counts [class, token]."""
    for seen in batch.column("seen"):
        yield from_planes(seen.as_py(), COUNT_BYTES).astype(np.int64).reshape(CLASSES, -1)


def _sums(batches):
    """Tokens of each class, distinct training tokens, ends of each class."""
    for batch in batches:
        for tokens, counts in zip(batch.column("tokens"), class_counts(batch), strict=True):
            split_up = tokens.as_py().split(b" ")
            ends = counts[:, split_up.index(b"")] if b"" in split_up else np.zeros(CLASSES, np.int64)
            sums = np.concatenate([counts.sum(axis=1), [counts.any(axis=0).sum()], ends]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["place", "total"])


def pressed(counts: np.ndarray) -> bytes:
    """Counts of a part of the table, mostly few or none: small before a writer gathers them."""
    width = max(1, -(-int(counts.max()).bit_length() // 8))
    return bytes([width]) + pa.compress(planes(counts.ravel(), width), codec="zstd", asbytes=True)


def from_pressed(data: bytes, size: int) -> np.ndarray:
    return from_planes(pa.decompress(data[1:], data[0] * size, codec="zstd", asbytes=True), data[0]).astype(np.int64)


class Packed:
    """A table that travels small and is unpacked once a task."""

    def __init__(self, counts: np.ndarray):
        self.shape, self.data, self.unpacked = counts.shape, [pressed(c) for c in counts.reshape(-1, CHUNK)], None

    def table(self) -> np.ndarray:
        if self.unpacked is None:
            out = np.empty((len(self.data), CHUNK), np.uint16)
            for row, data in zip(out, self.data, strict=True):
                row[:] = from_pressed(data, CHUNK)
            self.unpacked = out.reshape(self.shape)
        return self.unpacked


def _met(group: pa.Table) -> np.ndarray:
    total = np.zeros(2 * CHUNK, np.int64)
    for row in group.column("seen"):
        total += from_pressed(row.as_py(), 2 * CHUNK)
    return total


def _summed(group: pa.Table) -> pa.Table:
    seen = pa.array([pressed(_met(group))], pa.binary())
    return pa.table({"block": group.column("block")[:1], "kind": group.column("kind")[:1], "seen": seen})


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts [bit, slot] in 16 bits. Larger ones of a slot shrink alike, and none to nothing."""
    less = np.maximum(np.frexp(counts.max(axis=0).astype(np.float64))[1] - 16, 0).astype(np.int64)
    return np.minimum(-(-counts >> less), (1 << 16) - 1).astype(np.uint16)


def _narrowed(group: pa.Table) -> pa.Table:
    seen = pa.array([pressed(narrow(_met(group).reshape(2, -1)))], pa.binary())
    return pa.table({"kind": group.column("kind")[:1], "seen": seen})


def context_counts(contexts: DataFrame) -> np.ndarray:
    """The table [bit, slot] over all training texts: 42 MB at any size of them. Tables of 64
    tasks meet first, so no group holds those of all tasks."""
    rows = (
        contexts.select("block", "kind", "seen")
        .groupBy("kind", "block").applyInArrow(_summed, "block bigint, kind int, seen binary")
        .groupBy("kind").applyInArrow(_narrowed, "kind int, seen binary").collect()
    )
    out = np.zeros((2, len(ORDERS) * SLOTS), np.uint16)
    for row in rows:
        out[:, row.kind * CHUNK : (row.kind + 1) * CHUNK] = from_pressed(row.seen, 2 * CHUNK).reshape(2, -1)
    return out


def after(counts: np.ndarray, j: int, context, node) -> list[np.ndarray]:
    """Zeros and ones after the contexts of one order."""
    at = slots_of(context, node) + j * SLOTS
    return [counts[bit].take(at).astype(np.float32) for bit in (0, 1)]


def log_odds(zeros: np.ndarray, ones: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of a one, and whether the context is known; a given bit is taken out once."""
    if own is not None:
        ones, zeros = np.maximum(ones - own, 0), np.maximum(zeros - (1 - own), 0)
    odds = np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR)))
    return np.clip(odds, -STEEPEST, STEEPEST), ones + zeros > 0


def inputs(counts: np.ndarray, contexts, node, bit, without_own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of a one by each predictor and a constant, and how many predictors know the context."""
    found = [log_odds(*after(counts, j, c, node), bit if without_own else None) for j, c in enumerate(contexts)]
    x = np.stack([*(odds for odds, _ in found), np.full(len(node), ALWAYS, np.float32)])
    return x, np.sum([there for _, there in found], axis=0)


def start_weights() -> np.ndarray:
    return np.tile(np.array([0.1, 0.15, 0.25, 0.35, 0.35, 0.0], np.float32), (GATES, 1))


def mixed(weights: np.ndarray, x, gate: np.ndarray) -> np.ndarray:
    """Log-odds of a one by the weights that the gates select; the last is a constant's."""
    total = (weights[:, -1] * np.float32(ALWAYS)).take(gate, mode="clip")
    for j, odds in enumerate(x):
        total += odds * weights[:, j].take(gate, mode="clip")
    return np.clip(total, -30, 30, out=total)


def cost(odds: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Natural logarithms of the probabilities of the bits, negated."""
    return np.log1p(np.exp(np.where(bit == 1, -odds, odds)))


def errors(weights: np.ndarray, x: list[np.ndarray], gate: np.ndarray, bit: np.ndarray, times: np.ndarray) -> np.ndarray:
    """For each gate, sums over bits that occur so often: their number, and their coding errors by input."""
    error = (bit - 1 / (1 + np.exp(-mixed(weights, x, gate)))) * times
    sums = [times, *(error * row for row in x), error * np.float32(ALWAYS)]
    return np.stack([np.bincount(gate, of, GATES) for of in sums])


def coded(runs: np.ndarray, counts: np.ndarray, weights: np.ndarray, turns: list, without_own: bool = True):
    """Natural logarithms of the probabilities of the distinct runs' own bytes after the others,
    without an occurrence of their own and with all counts, and the weights refined before by
    online steps. A step is the numbers of runs and how often each occurs; the weights move
    against its coding errors. The bits of a byte have sets of weights of their own, so the
    steps of one bit come before the next bit's."""
    weights, less, whole = weights.copy(), np.zeros(len(runs), np.float32), np.zeros(len(runs), np.float32)
    begins = range(0, len(runs), PIECE)
    pieces = [Grams(runs[b : b + PIECE]) for b in begins]
    cuts = [np.searchsorted(of, [*begins, len(runs)]).tolist() for of, _ in turns]
    for k in range(8):
        bit, seen = [bit_of(p.flat, k)[1] for p in pieces], [p.after(counts, k) for p in pieces]
        if without_own:
            ready = [p.odds(s, k, True) for p, s in zip(pieces, seen, strict=True)]
            for (of, times), cut in zip(turns, cuts, strict=True):
                sums = np.zeros((len(ORDERS) + 2, GATES))
                for n, begin in enumerate(begins):
                    here = slice(cut[n], cut[n + 1])
                    if cut[n] < cut[n + 1]:
                        at, (odds, gate) = of[here] - begin, ready[n]
                        x = [o.take(f.take(at), mode="clip") for o, f in zip(odds, pieces[n].of, strict=True)]
                        sums += errors(weights, x, gate.take(at).astype(np.int64), bit[n].take(at), times[here])
                weights += (RATE / (sums[0] + HOLD) * sums[1:]).T.astype(np.float32)
            for n, begin in enumerate(begins):
                odds, gate = ready[n]
                less[begin : begin + PIECE] -= cost(mixed(weights, pieces[n].of_runs(odds), gate), bit[n])
        for n, begin in enumerate(begins):
            odds, gate = pieces[n].odds(seen[n], k, False)
            whole[begin : begin + PIECE] -= cost(mixed(weights, pieces[n].of_runs(odds), gate), bit[n])
    return less, whole, weights


def refine(weights: np.ndarray, counts: np.ndarray, tokens: list[bytes]) -> np.ndarray:
    """One online pass over a stream of tokens, in steps, predicting before learning."""
    parts = [occurrences(grams([b" ".join(tokens[i : i + STEP]) + b" "])) for i in range(0, len(tokens), STEP)]
    runs = distinct(np.concatenate([r for r, _ in parts]))
    return coded(runs, counts, weights, [(np.searchsorted(runs, r), n.astype(np.float32)) for r, n in parts])[2]


def spelled(tokens: list[bytes], counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each token's spelling at the start of a text."""
    out = np.zeros(len(tokens))
    for begin in range(0, len(tokens), 20_000):
        part = tokens[begin : begin + 20_000]
        runs, of = numbered(grams([t + b" " for t in part]))
        costs = coded(runs, counts, weights, [], without_own=False)[1]
        lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
        out[begin : begin + len(part)] = np.add.reduceat(costs[of], np.cumsum(lengths) - lengths)
    return out


def _spelled(packed: Packed):
    def work(batches):
        counts, weights = packed.table(), start_weights()
        for batch in batches:
            found = [spelled(x.as_py().split(b" "), counts, weights).astype(np.float32).tobytes() for x in batch.column("tokens")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("seen"), pa.array(found, pa.binary())], names=["kind", "seen", "spelled"]
            )

    return work


def _shares(weights: tuple[float, float, float], tokens: int, in_class: list[int]):
    """What the class's and all frequencies explain of the training tokens."""
    before = np.maximum(np.array(in_class) - 1, 1)[:, None]

    def work(batches):
        sums = np.zeros(2)
        for batch in batches:
            for counts, spell in zip(class_counts(batch), batch.column("spelled"), strict=True):
                one = weights[0] * np.maximum(counts - 1, 0) / before
                two = weights[1] * np.maximum(counts.sum(axis=0) - 1, 0) / (tokens - 1)
                total = one + two + weights[2] * np.exp(np.frombuffer(spell.as_py(), np.float32).astype(np.float64))
                each = np.divide(counts, total, out=np.zeros_like(total), where=total > 0)
                sums += (each * one).sum(), (each * two).sum()
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(sums)], names=["place", "total"])

    return work


def source_weights(vocabulary: DataFrame, tokens: int, in_class: list[int], rounds: int = 8) -> tuple[float, float, float]:
    """Weights of the class's frequencies, of all frequencies and of the spelling, by
    expectation-maximisation on the training tokens, each predicted from the other ones."""
    if tokens < 2:
        return 0.0, 0.0, 1.0
    weights = (0.3, 0.3, 0.4)
    for _ in range(rounds):
        rows = (
            vocabulary.select("seen", "spelled").mapInArrow(_shares(weights, tokens, in_class), "place int, total double")
            .groupBy("place").agg(F.sum("total").alias("total")).orderBy("place").collect()
        )
        sums = [r.total / tokens for r in rows]
        one, two = (min(max(x, 1e-6), 0.49999) if x < 0.5 else min(x, 0.999) for x in sums)
        least = max(1 - one - two, 1e-4)
        weights = (one / (one + two + least), two / (one + two + least), least / (one + two + least))
    return weights


def _pair_totals(group: pa.Table) -> pa.Table:
    """Counts over all blocks of the pairs of one range, for each block in its own order."""
    pairs = [np.frombuffer(x, np.uint64) for x in group.column("pairs").to_pylist()]
    flat = np.concatenate(pairs)
    at, kinds = ranks(flat)
    seen = np.frombuffer(b"".join(group.column("seen").to_pylist()), np.int64)
    total = np.bincount(at, seen, kinds).astype(np.int64)[at]
    ends = np.cumsum([len(x) for x in pairs])
    return pa.table(
        {
            "block": group.column("block"), "kind": group.column("kind"),
            "counts": pa.array([total[e - len(x) : e].tobytes() for e, x in zip(ends, pairs, strict=True)], pa.binary()),
        }
    )


def _packed_totals(group: pa.Table) -> pa.Table:
    raw = {
        "pairs": [from_planes(x, HASH_BYTES).tobytes() for x in group.column("pairs").to_pylist()],
        "seen": [from_planes(x, COUNT_BYTES).tobytes() for x in group.column("seen").to_pylist()],
    }
    found = _pair_totals(pa.table({"block": group.column("block"), "kind": group.column("kind"), **raw}))
    packed = [planes(np.frombuffer(x, np.int64), COUNT_BYTES) for x in found.column("counts").to_pylist()]
    return pa.table({"block": found.column("block"), "kind": found.column("kind"), "counts": pa.array(packed, pa.binary())})


def _answers(asked: pa.Table, known: pa.Table) -> pa.Table:
    """What each block asks of one range: counts of its tokens, in their class too, and spellings
    if they are given."""
    counts = from_planes(known.column("seen")[0].as_py(), COUNT_BYTES).astype(np.int64).reshape(CLASSES, -1)
    total = counts.sum(axis=0)
    ids = [from_planes(x, ID_BYTES).astype(np.int64) for x in asked.column("ids").to_pylist()]
    kinds = [np.frombuffer(x, np.uint8) for x in asked.column("kinds").to_pylist()]
    told = {}
    if "spelled" in known.column_names:
        spelled_as = np.frombuffer(known.column("spelled")[0].as_py(), np.float32)
        told["spelled"] = pa.array([spelled_as[i].tobytes() for i in ids], pa.binary())
    return pa.table(
        {
            "asking": asked.column("block"), "kind": asked.column("kind"),
            "c": pa.array([planes(total[i], COUNT_BYTES) for i in ids], pa.binary()),
            "own": pa.array([planes(counts[k, i], COUNT_BYTES) for k, i in zip(kinds, ids, strict=True)], pa.binary()),
            **told,
        }
    )


def sources(c, own, in_class, pair, before, tokens: int, less: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies of tokens after the word before, in the class and in all texts, and the gate.
    `less` is 1 to take the token itself out of all counts."""
    before = np.maximum(before - less, 0)
    parts = np.stack(
        [(pair - less) / np.maximum(before, 1), (own - less) / np.maximum(in_class - less, 1), (c - less) / max(tokens - less, 1)]
    )
    gate = np.minimum((np.frexp(before.astype(np.float64))[1] + 1) // 2, BEFORE - 1)
    return np.maximum(parts, 0), gate


def start_gates(weights: tuple[float, float, float]) -> np.ndarray:
    """Weights of the word before, class, all texts and spelling. A word never seen has none."""
    pair = np.minimum(0.08 * np.arange(BEFORE), 0.6)[:, None]
    return np.concatenate([pair, (1 - pair) * np.array(weights)], axis=1)


def learn(gates: np.ndarray, sums: np.ndarray, parts: np.ndarray, spelled: np.ndarray, gate: np.ndarray) -> np.ndarray:
    """One online step: the shares of the sources in the predictions join the sums of all steps."""
    each = gates[gate].T * np.concatenate([parts, np.exp(spelled)[None]])
    each /= np.maximum(each.sum(axis=0), 1e-300)
    for j in range(len(each)):
        sums[:, j] += np.bincount(gate, each[j], BEFORE)
    return sums / sums.sum(axis=1, keepdims=True)


def log_mixture(gates: np.ndarray, parts: np.ndarray, spelled: np.ndarray, gate: np.ndarray) -> np.ndarray:
    """Natural logarithms. A spelling may be too unlikely for a double; alone it stays one."""
    by = gates[gate].T
    known = (by[:3] * parts).sum(axis=0)
    alone = np.log(by[3]) + spelled
    return np.where(known > 0, np.log(np.maximum(known + by[3] * np.exp(spelled), 1e-300)), alone)


class Block:
    """Documents of a block in a fixed order, with the counts of their tokens and pairs."""

    def __init__(self, rows: pa.Table, answers: pa.Table, tokens: int, in_class: list[int], starts: int, contexts: np.ndarray):
        totals = rows.filter(rows.column("counts").is_valid()).sort_by("kind")
        parts = [from_planes(x, COUNT_BYTES) for x in totals.column("counts").to_pylist()]
        self.totals = np.concatenate([np.empty(0, np.uint64), *parts]).astype(np.int64)
        self.documents = rows.filter(rows.column("ids").is_valid()).sort_by(
            [("doc_id", "ascending"), ("bytes", "ascending"), ("ids", "ascending")]
        )
        # Rows of the block's own tokens and of the answers about them, by ranges alike.
        own = answers.filter(answers.column("ids").is_valid()).sort_by("kind")
        told = answers.filter(answers.column("c").is_valid()).sort_by("kind")
        order = np.argsort(np.concatenate([from_planes(x, ID_BYTES) for x in own.column("ids").to_pylist()]))
        hashes = np.concatenate([from_planes(x, HASH_BYTES) for x in own.column("pairs").to_pylist()])[order]
        self.c, self.own = (
            np.concatenate([from_planes(x, COUNT_BYTES) for x in told.column(name).to_pylist()])[order].astype(np.int64)
            for name in ("c", "own")
        )
        listed = [t for x in own.column("tokens").to_pylist() for t in x.split(b" ")]
        self.listed = [listed[i] for i in order.tolist()]
        ids = [from_planes(x, ID_BYTES).astype(np.int32) for x in self.documents.column("ids").to_pylist()]
        self.lengths = np.array([len(x) for x in ids], np.int64)
        self.flat = np.concatenate(ids)
        self.ends = np.cumsum(self.lengths)
        pairs = pair_hashes(hashes, self.flat, self.ends - self.lengths)
        self.at = ranks(pairs)[0]
        self.kind = self.documents.column("kind").to_numpy()
        self.training = ~self.documents.column("held_out").to_numpy().astype(bool)
        self.tokens, self.in_class, self.starts = tokens, np.array(in_class), starts
        self.spelled = self.spellings(contexts)
        del self.listed

    def spellings(self, contexts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each slice, natural logarithms of the probabilities of its tokens' bytes after the
        bytes before them: without their own occurrence, and with all counts."""
        places, numbers, turns = [], [], []
        for begin, end in self.slices():
            own, of = numbered(grams(self.texts(begin, end)))
            places.append(own)
            numbers.append(of)
        runs, at, sizes = distinct(np.concatenate(places)), [], np.fromiter(map(len, self.listed), np.int64, len(self.listed)) + 1
        starts = []
        for (begin, end), own, of in zip(self.slices(), places, numbers, strict=True):
            at.append(np.searchsorted(runs, own).astype(np.int32))
            lengths = sizes[self.flat[self.ends[begin] - self.lengths[begin] : self.ends[end - 1]]]
            starts.append((np.cumsum(lengths) - lengths).astype(np.int32))
            use = np.repeat(np.repeat(self.training[begin:end], self.lengths[begin:end]), lengths)
            times = np.bincount(of[use], minlength=len(own))
            turns.append((at[-1][times > 0], times[times > 0].astype(np.float32)))
        del places, own, of, use, times
        less, whole, _ = coded(runs, contexts, start_weights(), turns)
        return [
            tuple(np.add.reduceat(costs.take(a).take(of), start, dtype=np.float64) for costs in (less, whole))
            for a, of, start in zip(at, numbers, starts, strict=True)
        ]

    def texts(self, begin: int, end: int) -> list[bytes]:
        rows = zip(self.ends[begin:end].tolist(), self.lengths[begin:end].tolist(), strict=True)
        return [b" ".join([self.listed[i] for i in self.flat[e - n : e].tolist()]) + b" " for e, n in rows]

    def slices(self):
        for begin in range(0, len(self.documents), TEXTS):
            yield begin, min(begin + TEXTS, len(self.documents))

    def features(self, begin: int, end: int, less: int):
        """Numbers of the tokens of some documents, where each starts, sources and gates."""
        first = self.ends[begin] - self.lengths[begin]
        here = slice(first, self.ends[end - 1])
        ids, start = self.flat[here], (self.ends - self.lengths)[begin:end] - first
        before = np.empty(len(ids), np.int64)
        before[1:] = self.c[ids[:-1]]
        before[start] = self.starts
        of = np.repeat(self.in_class[self.kind[begin:end]], self.lengths[begin:end])
        return ids, start, *sources(self.c[ids], self.own[ids], of, self.totals[self.at[here]], before, self.tokens, less)

    def training_features(self, begin: int, end: int):
        _, _, parts, gate = self.features(begin, end, 1)
        use = np.repeat(self.training[begin:end], self.lengths[begin:end])
        return parts[:, use], self.spelled[begin // TEXTS][0][use], gate[use]


def block_gates(block: Block, weights: tuple[float, float, float]) -> np.ndarray:
    """Weights refined by one online pass over the block's training tokens, each predicted from
    all others before it moves them."""
    gates = start_gates(weights)
    sums = None
    for begin, end in block.slices():
        step = block.training_features(begin, end)
        for _ in range(0 if begin else WARM):
            gates = learn(gates, gates * TRUST, *step)
        if sums is None:
            sums = gates * TRUST
        gates = learn(gates, sums, *step)
    return gates


def _score(
    tokens: int, kinds: int, in_class: list[int], ends: list[int], weights: tuple[float, float, float], contexts: Packed
):
    class_cost = np.log10((np.array(ends) + 0.5) / (sum(ends) + 0.5 * CLASSES))

    def work(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block, tables = Block(rows, answers, tokens, in_class, sum(ends), contexts.table()), []
        gates = block_gates(block, weights)
        base = np.log10((block.c + 0.5) / (tokens + 0.5 * (kinds + 1)))
        for begin, end in block.slices():
            ids, start, parts, gate = block.features(begin, end, 0)
            part = block.documents.slice(begin, end - begin)
            found = log_mixture(gates, parts, block.spelled[begin // TEXTS][1], gate) / np.log(10)
            score = np.add.reduceat(found, start) + class_cost[block.kind[begin:end]]
            tables.append(
                pa.table(
                    {
                        "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                        "n_tokens": block.lengths[begin:end], "n_known": np.add.reduceat((block.c > 0)[ids].astype(np.int64), start),
                        "train_tokens": np.full(end - begin, tokens, np.int64), "base_score": np.add.reduceat(base[ids], start),
                        "score": score,
                        "bits_per_byte": -score / np.log10(2) / np.maximum(part.column("bytes").to_numpy(), 1),
                    }
                )
            )
        return pa.concat_tables(tables)

    return work


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score_documents(documents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, counts of tokens, the frequency baseline and the model's score."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    centres = text_classes(rows.where("not held_out").select("doc_id", "text"))
    if not size and rows.isEmpty():
        return spark.createDataFrame([], RESULT)
    path = stored(rows.mapInArrow(_blocks(centres, blocks, block_bytes), PARTS), "part")

    def part(of: str, kind: str, schema: str) -> DataFrame:
        return spark.read.schema(schema.split(", ", 1)[1]).parquet(f"{of}/part={kind}")

    # Pairs first: their rows go as soon as they are counted.
    shape = "block bigint, kind int, counts binary"
    totals = spark.read.schema(shape).parquet(stored(
        part(path, "pairs", PARTS).select("block", "kind", "pairs", "seen").groupBy("kind").applyInArrow(_packed_totals, shape)
    ))
    discard_stored(spark, f"{path}/part=pairs")
    counted = stored(
        part(path, "tokens", PARTS).select("block", "kind", "tokens", "kinds", "seen")
        .groupBy("kind").applyInArrow(_vocabulary, VOCABULARY), "part",
    )
    vocabulary = part(counted, "vocabulary", VOCABULARY).select("kind", "tokens", "seen")
    sums = [r.total for r in vocabulary.mapInArrow(_sums, "place int, total bigint").groupBy("place").agg(
        F.sum("total").alias("total")).orderBy("place").collect()]
    in_class, kinds, ends = sums[:CLASSES], sums[CLASSES], sums[CLASSES + 1 :]
    tokens, counts = sum(in_class), Packed(context_counts(part(path, "contexts", PARTS)))
    discard_stored(spark, f"{path}/part=contexts")
    shape = "kind int, seen binary, spelled binary"
    known = spark.read.schema(shape).parquet(stored(vocabulary.mapInArrow(_spelled(counts), shape)))
    discard_stored(spark, f"{counted}/part=vocabulary")
    weights = source_weights(known, tokens, in_class)
    answers = (
        part(counted, "answers", VOCABULARY).select("block", "kind", "ids", "kinds").groupBy("kind")
        .cogroup(known.drop("spelled").groupBy("kind")).applyInArrow(_answers, "asking bigint, kind int, c binary, own binary")
    )
    own = part(path, "tokens", PARTS).select(F.col("block").alias("asking"), "kind", "tokens", "ids", "pairs")
    texts = part(path, "documents", PARTS).select("block", "doc_id", "held_out", "kind", "ids", "bytes")
    met = texts.unionByName(totals, allowMissingColumns=True).groupBy("block").cogroup(
        own.unionByName(answers, allowMissingColumns=True).groupBy("asking")
    )
    return met.applyInArrow(_score(tokens, kinds, in_class, ends, weights, counts), RESULT)
