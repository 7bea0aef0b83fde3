"""Near duplicates: one-permutation hashing, densified, banded, linked by stars.

Documents with equal shingle sets form a class; one document stands for it. The shingles of
a class go into bins by one hash, each bin keeps its least one, and an empty bin takes
the value of a full bin that a fixed probe order names (optimal densification). Five bins
make a band, and classes that agree in a band share a bucket. The number of bands follows the
threshold, so that a pair at it misses all of them with a chance below one in a million: 24
bands for 85 %, 35 for 80 %.

Inside a bucket the least id is the hub, and only pairs with it are confirmed, on whole
sets. A bucket whose members this leaves in different components is taken up again: its
members are cut into blocks of 256, every pair of blocks is one bounded group, and in it
sketches of 512 bins tell which members of different components may be linked. Only those
pairs leave the group, and they are confirmed on whole sets too. The sketch rules a pair out
five standard deviations below the threshold, so no link of a bucket is lost by it, while
dissimilar members of a large bucket never become rows.

Null or empty texts have no shingles and link with nothing. Rows that share a doc_id count
as one node. A null doc_id stays null and links with nothing. Further columns are ignored.
`without_copies` leaves such unlinked rows in the table, and one row of several with one
doc_id and equal shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.llm import words as W
from oncallmart.llm.components import components
from oncallmart.session import settle

BANDS, ROWS = 24, 5
BINS = BANDS * ROWS
PERCENT = 85
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
SKETCH, BLOCK = 512, 256
MISS = 1e-6
SET_KEY = ["shingle_count", "shingle_sum", "shingle_xor"]
SIGNATURE = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>"


def bands_for(percent: int) -> int:
    """How many bands a pair at the threshold misses with a chance below MISS."""
    return int(np.ceil(np.log(MISS) / np.log1p(-((percent / 100) ** ROWS)))) if percent < 100 else 1


def densify(bins: np.ndarray) -> np.ndarray:
    """Fill empty bins of each row from that row's full ones. Every bin has its own fixed
    random order of donors, the same for all rows. Rows without a full bin stay empty."""
    full, width = bins != EMPTY, bins.shape[1]
    out = bins.copy()
    row, place = np.nonzero(~full & full.any(axis=1, keepdims=True))
    attempt = 0
    while len(row):
        if attempt < 512:
            probe = W.mix(place.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(attempt + 1))
            donor = (probe % np.uint64(width)).astype(np.int64)
        else:
            donor = (place + attempt) % width
        hit = full[row, donor]
        out[row[hit], place[hit]] = bins[row[hit], donor[hit]]
        row, place = row[~hit], place[~hit]
        attempt += 1
    return out


def bin_minima(sets: list[np.ndarray], width: int = BINS) -> np.ndarray:
    out = np.full(len(sets) * width, EMPTY)
    flat = np.concatenate([*sets, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    spread = W.mix(flat + np.uint64(0x9E3779B97F4A7C15))
    place = (spread >> np.uint64(32)) % np.uint64(width)
    np.minimum.at(out, owner * width + place.astype(np.int64), spread)
    return out.reshape(len(sets), width)


def band_numbers(bins: np.ndarray) -> np.ndarray:
    bands = bins.shape[1] // ROWS
    rows = densify(bins).reshape(len(bins), bands, ROWS)
    total = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        total = W.mix(total + rows[:, :, k])
    return total


def as_lists(bands: np.ndarray) -> pa.Array:
    ends = np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, bands.reshape(-1).view(np.int64))


def set_keys(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and two sums of each set; equal sets have equal ones."""
    sums = [int(W.mix(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
    xors = [int(np.bitwise_xor.reduce(s)) if len(s) else 0 for s in sets]
    return [
        pa.array([len(s) for s in sets], pa.int64()),
        pa.array(np.array(sums, np.uint64).view(np.int64)),
        pa.array(np.array(xors, np.uint64).view(np.int64)),
    ]


def _sign(bands: int):
    def work(batches):
        numbers = W.word_numbers()
        for batch in batches:
            sets = [W.shingles(t, numbers) for t in W.as_bytes(batch.column("text"))]
            found = band_numbers(bin_minima(sets, bands * ROWS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *set_keys(sets),
                    as_lists(found),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return work


def sketch(shingles: np.ndarray) -> bytes:
    """One byte for each of 512 bins: a mark of the bin's least shingle, 0 if it has none."""
    spread = W.mix(shingles + np.uint64(0xD1B54A32D192ED03))
    least = np.full(SKETCH, EMPTY)
    np.minimum.at(least, ((spread >> np.uint64(40)) % np.uint64(SKETCH)).astype(np.int64), spread)
    marks = (least % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return np.where(least == EMPTY, np.uint8(0), marks).tobytes()


def _sets(bands: int):
    def work(batches):
        numbers = W.word_numbers()
        for batch in batches:
            sets = [W.shingles(t, numbers) for t in W.as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").cast(pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    pa.array([sketch(s) for s in sets], pa.binary()),
                    as_lists(band_numbers(bin_minima(sets, bands * ROWS))),
                ],
                names=["id", "shingles", "sketch", "bands"],
            )

    return work


def may_link(marks, size, other_marks, other_sizes, percent: int) -> np.ndarray:
    """Which of several sketches may belong to sets that share `percent` with the first."""
    least = percent / 100
    either = np.maximum(((other_marks | marks) != 0).sum(axis=1), 1)
    same = ((other_marks == marks) & (marks != 0)).sum(axis=1)
    union = (size + other_sizes) / (1 + least)
    spread = np.sqrt(least * (1 - least) / either * np.clip(1 - either / union, 0.02, 1))
    small, large = np.minimum(size, other_sizes), np.maximum(size, other_sizes)
    return (same / either >= least - 5 * spread - 0.02) & (100 * small >= percent * large)


def _tile(percent: int):
    """Pairs of different components, one member of each of two blocks, that may be linked."""

    def work(tile: pa.Table) -> pa.Table:
        ids, parts, sizes = (tile.column(c).to_numpy() for c in ("id", "component", "size"))
        block, one, two = (tile.column(c).to_numpy() for c in ("block", "one", "two"))
        marks = np.frombuffer(b"".join(tile.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        bands = tile.column("bands").combine_chunks().flatten().to_numpy().reshape(len(tile), -1)
        bucket = tile.column("bucket")[0].as_py()
        right = np.flatnonzero(block == two)
        found = []
        for a in np.flatnonzero(block == one).tolist():
            b = right[(parts[right] != parts[a]) & ((ids[right] > ids[a]) | (one[0] != two[0]))]
            if len(b):
                b = b[may_link(marks[a], sizes[a], marks[b], sizes[b], percent)]
                # A pair is reported by the first of the buckets that it shares.
                same = bands[b] == bands[a]
                b = b[bands[a][same.argmax(axis=1)] == bucket]
                found.append(np.stack([np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])]))
        both = np.concatenate([*found, np.empty((2, 0), np.int64)], axis=1)
        return pa.table({"hub": pa.array(both[0], pa.int64()), "id": pa.array(both[1], pa.int64())})

    return work


def leftover(buckets: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, id) that share a bucket, lie in different components and may be linked."""
    placed = buckets.join(parts, "id", "left").select(
        "bucket", "id", F.coalesce("component", "id").alias("component")
    )
    mixed = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
        .where("low < high")
        .select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    members = placed.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    marks = sets.select("id", "sketch", "bands", F.size("shingles").alias("size"))
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("block")).alias("one"), F.greatest(k, F.col("block")).alias("two")),
    )
    return (
        members.join(marks, "id")
        .select("bucket", "id", "component", "size", "sketch", "bands", "block", F.inline(tiles))
        .groupBy("bucket", "one", "two")
        .applyInArrow(_tile(percent), "hub bigint, id bigint")
        .distinct()
    )


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (hub, id) whose whole sets share `percent` of their union or more."""
    hubs = sets.select(F.col("id").alias("hub"), F.col("shingles").alias("hub_shingles"))
    both = F.size(F.array_intersect("shingles", "hub_shingles"))
    union = F.size("shingles") + F.size("hub_shingles") - both
    members = sets.select("id", "shingles")
    return (
        pairs.join(members, "id").join(hubs, "hub").where(both * 100 >= union * percent).select("hub", "id")
    )


def link(buckets: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Component of every linked id, from buckets (bucket, id) and the ids' whole sets."""
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("hub"))
    star = buckets.join(hubs, "bucket").where("id != hub")
    edges = settle(confirm(star.select("hub", "id").distinct(), sets, percent))
    parts = settle(components(edges))
    more = settle(confirm(leftover(buckets, parts, sets, percent), sets, percent))
    return parts if more.isEmpty() else settle(components(edges.union(more)))


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (least reachable doc_id), kept (it is that one)."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    bands = bands_for(percent)
    signed = settle(texts.mapInArrow(_sign(bands), SIGNATURE))
    key = ["n_shingles", "set_a", "set_b"]
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy(key).agg(F.min("doc_id").alias("id"))
    stands = classes.select(F.col("id").alias("doc_id")).distinct()
    spread = filled.join(stands, "doc_id", "left_semi").select(
        F.col("doc_id").alias("id"), F.explode("bands").alias("bucket")
    ).distinct()
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    buckets = settle(spread.join(shared, "bucket", "left_semi"))
    wanted = buckets.select(F.col("id").alias("doc_id")).distinct()
    sets = settle(
        texts.join(wanted, "doc_id", "left_semi")
        .withColumnRenamed("doc_id", "id")
        .mapInArrow(_sets(bands), "id bigint, shingles array<bigint>, sketch binary, bands array<bigint>")
    )
    parts = link(buckets, sets, percent)
    named = classes.join(parts, "id", "left").select(
        *key, F.coalesce("component", "id").alias("component_id")
    )
    linked = filled.select("doc_id", *key).join(named, key).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return linked.union(alone).withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without all but the first of each group, in their own columns."""
    kept = near_duplicates(documents, percent).where("kept").select("doc_id").distinct()
    return documents.join(kept, "doc_id", "left_semi").select(documents.columns)


def _keyed(batches):
    numbers = W.word_numbers()
    for batch in batches:
        keys = set_keys([W.shingles(t, numbers) for t in W.as_bytes(batch.column("text"))])
        yield pa.RecordBatch.from_arrays([*batch.columns, *keys], names=[*batch.schema.names, *SET_KEY])


def one_of_each(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """One row, the least, of those with one doc_id and equal shingle sets, but none of the ids
    `dropped`; all rows without shingles."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    keyed = settle(rows.mapInArrow(_keyed, f"{fields}, " + ", ".join(f"{k} bigint" for k in SET_KEY)))
    least = (
        keyed.where(F.col(SET_KEY[0]) > 0).join(dropped, "doc_id", "left_anti").groupBy("doc_id", *SET_KEY)
        .agg(F.min(F.struct(*rows.columns)).alias("row")).select("row.*")
    )
    return least.union(keyed.where(F.col(SET_KEY[0]) == 0).select(rows.columns))


def without_copies(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without all but one row of each group, in their own columns. Rows that
    link with nothing stay: those without words, and those with a null doc_id."""
    stay = settle(
        near_duplicates(documents, percent).where("doc_id is not null").groupBy("doc_id")
        .agg(F.count("*").alias("n"), F.expr("bool_or(kept)").alias("any"), F.expr("bool_or(kept and n_shingles > 0)").alias("words"))
        .where("any")
    )
    out = documents.where("doc_id is null").union(
        documents.join(stay.where("n = 1"), "doc_id", "left_semi").select(documents.columns)
    )
    again = stay.where("n > 1")
    if again.isEmpty():
        return out
    dropped = again.where("not words").select("doc_id")
    return out.union(one_of_each(documents.join(again, "doc_id", "left_semi").select(documents.columns), dropped))
