"""Text fingerprints by locally consistent parsing.

A text is parsed in rounds. Runs of one symbol become one symbol. Deterministic coin tossing
gives each symbol a small label from the lowest bit in which it differs from the one before,
three times over; a symbol whose label is greater than both neighbours' starts a phrase. A
phrase is named by a hash of its symbols, and the names are the next round's symbols. Labels
look at a few neighbours only, so equal substrings get equal names in their inside, wherever
they lie. The fingerprint keeps, of the names of four rounds (of
the first only where it has few), the least in each of 64 slots.

A null text counts as empty; an empty text's slots are all empty. Equal texts have equal
fingerprints. Rows with equal doc_id are in the order of their texts, and a null doc_id is
below all others. Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.llm.words import FACTORS, mix

ROUNDS, SLOTS, SHORT = 4, 64, 16
CHUNK = 1_000_000
# Rows of a task, about, and most tasks; with more rows than both allow, tasks grow.
TASK_ROWS, MOST_TASKS = 2000, 20_000
RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
LEAST = -(1 << 63)


def toss_table(labels: int) -> np.ndarray:
    """New label by (label before, label), for labels below a power of two."""
    before, own = np.meshgrid(np.arange(labels), np.arange(labels), indexing="ij")
    differ = before ^ own
    low = np.bitwise_count((differ & -differ) - 1) % 64
    return (2 * low + ((own >> low) & 1)).astype(np.uint8).reshape(-1)


SECOND, THIRD = toss_table(128), toss_table(16)
PLACES = np.array(FACTORS, np.uint64)


def first_labels(symbols: np.ndarray, start: np.ndarray) -> np.ndarray:
    differ = np.empty_like(symbols)
    differ[1:] = symbols[1:] ^ symbols[:-1]
    differ[start] = 1
    low = np.bitwise_count((differ & (~differ + differ.dtype.type(1))) - differ.dtype.type(1))
    # Equal neighbours are gone by now, but for two names that collide.
    low &= 63
    bit = (symbols >> low.astype(symbols.dtype)).astype(np.uint8) & 1
    return 2 * low + bit


def again(labels: np.ndarray, start: np.ndarray, table: np.ndarray, size: int) -> np.ndarray:
    pair = labels.astype(np.uint16)
    pair[1:] += labels[:-1].astype(np.uint16) * np.uint16(size)
    pair[start] = labels[start] + np.uint16(size) * (labels[start] ^ 1)
    return table[pair]


def phrases(symbols: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of texts that lie one behind the other, and the texts' new starts.
    Every text has a symbol at least."""
    keep = np.empty(len(symbols), bool)
    keep[1:] = symbols[1:] != symbols[:-1]
    keep[start] = True
    at = np.flatnonzero(keep)
    if len(at) < len(symbols):
        run = np.diff(at, append=len(symbols))
        start = np.searchsorted(at, start)
        symbols = symbols[at].astype(np.uint64)
        long = run > 1
        symbols[long] = mix(symbols[long] + (run[long].astype(np.uint64) << np.uint64(32)))
    labels = first_labels(symbols, start)
    labels = again(labels, start, SECOND, 128)
    labels = again(labels, start, THIRD, 16)
    top = np.empty(len(labels), bool)
    rises = labels[1:] > labels[:-1]
    top[1:] = rises
    top[:-1] &= ~rises
    top[start] = True
    begin = np.flatnonzero(top)
    length = np.diff(begin, append=len(labels))
    place = np.arange(len(labels), dtype=np.int64) - np.repeat(begin, length)
    place &= len(PLACES) - 1
    sums = np.add.reduceat(symbols.astype(np.uint64) * PLACES[place], begin)
    return mix(sums + length.astype(np.uint64)), np.searchsorted(begin, start)


def sketch(texts: list[str]) -> np.ndarray:
    """Fingerprints of texts as rows of 64 numbers of 16 bits; 0 is an empty slot."""
    out = np.full(len(texts) * SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
    filled = [k for k, t in enumerate(texts) if t]
    done = 0
    while done < len(filled):
        part, size = [], 0
        while done < len(filled) and size < CHUNK:
            part.append(filled[done])
            size += len(texts[filled[done]])
            done += 1
        _sketch_part(texts, np.array(part), out)
    out = out.reshape(len(texts), SLOTS)
    short = (mix(out) >> np.uint64(48)).astype(np.uint16)
    return np.where(out == np.uint64(0xFFFFFFFFFFFFFFFF), 0, np.maximum(short, 1)).astype(np.uint16)


def _sketch_part(texts: list[str], part: np.ndarray, out: np.ndarray) -> None:
    symbols = np.frombuffer("".join([texts[k] for k in part]).encode("utf-32-le"), np.uint32)
    lengths = np.array([len(texts[k]) for k in part], np.int64)
    start = np.cumsum(lengths) - lengths
    for turn in range(ROUNDS):
        symbols, start = phrases(symbols, start)
        counts = np.diff(start, append=len(symbols))
        named, owner = symbols, np.repeat(part, counts)
        if turn == 0:
            # Names of the first round are common to all texts; only short texts need them.
            short = np.repeat(counts < SHORT, counts)
            named, owner = named[short], owner[short]
        value = mix(named ^ np.uint64(turn + 1))
        slot = owner * SLOTS + (value & np.uint64(SLOTS - 1)).astype(np.int64)
        np.minimum.at(out, slot, value)


def likeness(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Share of the slots filled in either fingerprint that agree; 1 for two empty ones."""
    either = (one != 0) | (two != 0)
    same = ((one == two) & either).sum(axis=1)
    total = either.sum(axis=1)
    return np.where(total > 0, same / np.maximum(total, 1), 1.0)


def as_text(rows: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in rows]


def edit(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows(doc_ids: list, texts: list[str], owns: list[bool], following: str | None) -> pa.RecordBatch:
    """Results for the rows marked as own; the next row's text is `following` for the last."""
    nexts = texts[1:] + ([following] if following is not None else [])
    keep = [k for k in range(len(nexts)) if owns[k]]
    whole = sketch(texts + nexts[len(texts) - 1 :])
    edited = [edit(texts[k], nexts[k]) for k in keep]
    marks = sketch(edited)
    own = whole[keep]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([doc_ids[k] for k in keep], pa.int64()),
            pa.array([len(texts[k]) for k in keep], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(as_text(own), pa.string()),
            pa.array(as_text(marks), pa.string()),
            pa.array(likeness(own, marks)),
            pa.array(likeness(own, whole[[k + 1 for k in keep]])),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _compare(batches):
    """Rows come in order; every own row is followed by its next document, own or guest."""
    held: tuple | None = None
    for batch in batches:
        for begin in range(0, len(batch), 500):
            part = batch.slice(begin, 500)
            ids = part.column("doc_id").to_pylist()
            texts = [t or "" for t in part.column("text").to_pylist()]
            owns = [s % 2 == 0 for s in part.column("slot").to_pylist()]
            if held is not None:
                ids, texts, owns = [held[0], *ids], [held[1], *texts], [held[2], *owns]
            if len(ids) > 1:
                yield _rows(ids[:-1], texts[:-1], owns[:-1], texts[-1])
            held = (ids[-1], texts[-1], owns[-1])


def _slots(bounds: np.ndarray, guests: dict[int, int] | None):
    """Column of the slots of a key: twice its block, and twice the block before plus one
    when it is the first of its block and so the next document of that block's last."""

    @F.pandas_udf("array<int>")
    def slots(keys: pd.Series) -> pd.Series:
        blocks = len(bounds) - np.searchsorted(bounds, keys.to_numpy(), side="right")
        return pd.Series(
            [
                [2 * b] if guests is None or k not in guests else [2 * b, 2 * guests[k] + 1]
                for k, b in zip(keys.tolist(), blocks.tolist(), strict=True)
            ]
        )

    return slots


def fingerprints(documents: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like they are.

    The order by doc_id is cut into blocks at quantiles. The driver learns the cuts and the
    first id of each block, at most 20,000 numbers; the texts are moved once.
    """
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text",
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LEAST)).alias("key"),
    )
    keys = rows.select("key")
    n = keys.count()
    blocks = max(1, min(-(-n // TASK_ROWS), MOST_TASKS))
    cuts = keys.approxQuantile("key", [k / blocks for k in range(1, blocks)], 0.2 / blocks) if blocks > 1 else []
    bounds = np.unique(np.array([int(c) for c in cuts], np.int64))
    tops = (
        keys.select("key", _slots(bounds, None)("key")[0].alias("slot"))
        .groupBy("slot").agg(F.max("key").alias("top")).orderBy("slot").collect()
    )
    guests = {r.top: tops[k - 1].slot // 2 for k, r in enumerate(tops)}
    return (
        rows.withColumn("slot", F.explode(_slots(bounds, guests)("key")))
        .repartitionById(len(bounds) + 1, F.expr("cast(slot div 2 as int)"))
        .sortWithinPartitions("slot", F.desc("key"), "text")
        .select("doc_id", "text", "slot")
        .mapInArrow(_compare, RESULT)
    )
