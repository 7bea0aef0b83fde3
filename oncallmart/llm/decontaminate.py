"""Benchmark items inside long documents: size-partitioned MinHash containment search.

Documents are partitioned by the power of two of their number of distinct shingles, items by
that of theirs. For each class of items a document has a one-permutation sketch: so many bins
that a document of its partition keeps a given share of its shingles, each the least of its
bin. The share falls with the size of the items, since a larger item has more shingles that
may be met: it is the least with which an item contained to 80 % meets no bin with a chance
of one in a million. Items with fewer than 16 shingles need every shingle, which is a sketch
with a bin for each. An item that meets a bin's value is a candidate of the document; nothing
else makes one.

Candidates are then confirmed: the item's shingles are looked up among the document's, and
the exact containment decides. Texts are read once. Before rows leave the scan, a Bloom filter
of all items' shingles drops those in no item; it never drops one that is. Its bits are the
only thing that goes to every task, 64 a shingle of the items, half a MB to 32 MB together; beyond
that it drops less, and results stay the same.

Texts are lower-cased (A-Z) and split at ASCII white space; shingles take five words. An item
with fewer words is one shingle, its whole sequence, and is looked up among the document's
windows of its own length, so that it is found inside long texts, too. A null or empty text or
item has no shingle and no match. Rows with equal doc_id or item_id count as one document or
item with the shingles of all. Null ids never match. Further columns are ignored; with an
empty table on either side the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.llm import words as W
from oncallmart.session import settle

PERCENT = 80
# Bits of the filter for each shingle of the items, and the least and most in all.
BLOOM_EACH, BLOOM_LEAST, BLOOM_MOST = 64, 1 << 22, 1 << 28
# Below this many shingles an item is looked up under all shingles of a document.
SHORT = 16
# Chance that an item meets none of a document's bins.
MISS = 1e-6


def bloom_size(shingles: int) -> int:
    """Bits of the filter: a power of two that follows the number of shingles."""
    return min(max(1 << (shingles * BLOOM_EACH - 1).bit_length(), BLOOM_LEAST), BLOOM_MOST) if shingles else BLOOM_LEAST


def bloom_places(shingles: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    step = W.mix(shingles) | np.uint64(1)
    return tuple(((shingles + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64) for k in range(3))


def in_bloom(bits: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """Which shingles the filter may hold; later places are looked up for those that passed."""
    first = (shingles & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    left = np.flatnonzero(bits[first >> 3] >> (first & 7).astype(np.uint8) & 1)
    some = np.ones(len(left), bool)
    for place in bloom_places(shingles[left], 8 * len(bits))[1:]:
        some &= bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
    out = np.zeros(len(shingles), bool)
    out[left[some]] = True
    return out


def bloom(items: DataFrame, size: int, parts: int = 4) -> np.ndarray:
    """Bits of the filter. At most `parts` partial filters of this size come to the driver."""

    def part(batches):
        bits = np.zeros(size, bool)
        for batch in batches:
            for place in bloom_places(batch.column("shingle").to_numpy().view(np.uint64), size):
                bits[place] = True
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits, bitorder="little").tobytes()])], names=["bits"])

    out = np.zeros(size // 8, np.uint8)
    for row in items.select("shingle").repartition(parts).mapInArrow(part, "bits binary").toLocalIterator():
        out |= np.frombuffer(row.bits, np.uint8)
    return out


def _item_shingles(batches):
    numbers = W.word_numbers()
    for batch in batches:
        texts = W.as_bytes(batch.column("text"))
        sets = [W.shingles(t, numbers) for t in texts]
        lengths = [min(len(W.split(t)), W.WIDTH) for t in texts]
        each = [len(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(batch.column("item_id").to_numpy(zero_copy_only=False).astype(np.int64), each)),
                pa.array(np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)),
                pa.array(np.repeat(np.array(lengths, np.int32), each)),
            ],
            names=["item_id", "shingle", "words"],
        )


def class_of(n_item: int) -> int:
    """Class of an item: 0 below `SHORT` shingles, then one for each power of two."""
    return 0 if n_item < SHORT else n_item.bit_length() - SHORT.bit_length() + 1


def share(cls: int, percent: int) -> float:
    """Share of a document's shingles that its sketch for a class of items must keep."""
    if cls == 0:
        return 1.0
    least = -(-(SHORT << (cls - 1)) * percent // 100)
    return 1.0 - MISS ** (1.0 / max(least, 1))


def bins_each(kept: float) -> float:
    """Bins for each shingle so that this share of them is the least of its bin: x with
    x * (1 - exp(-1 / x)) = kept, by halving."""
    low, high = 0.0, 1e6
    for _ in range(100):
        x = (low + high) / 2
        low, high = (x, high) if x * -np.expm1(-1 / x) < kept else (low, x)
    return high


def sketched(shingles: np.ndarray, each: float) -> np.ndarray:
    """Which of a document's shingles are the least of their bin, with `each` bins for every
    shingle of the largest document of its partition."""
    largest = 1 << (max(len(shingles), 1) - 1).bit_length()
    spread = W.mix(shingles)
    bins = (spread % np.uint64(max(1, int(np.ceil(each * largest))))).astype(np.int64)
    order = np.lexsort((spread, bins))
    first = np.empty(len(order), bool)
    first[order] = np.diff(bins[order], prepend=-1) != 0
    return first


def document_set(text: bytes | None, numbers: W.Remembered, widths: list[int]) -> np.ndarray:
    """Shingles of a text, and its windows of each of the lengths that short items have."""
    whole = W.shingles(text, numbers)
    return np.unique(np.concatenate([whole, *(W.shingles(text, numbers, w) for w in widths)])) if widths else whole


def _document_shingles(sent, widths: list[int], classes: list[int], percent: int):
    """Rows (doc_id, shingle, classes): bit q of `classes` says that the shingle is in the
    document's sketch for items of class q."""
    sketches = [(q, bins_each(share(q, percent))) for q in classes if q]
    every = 1 if 0 in classes else 0

    def work(batches):
        bits = sent.value
        numbers = W.word_numbers()
        for batch in batches:
            found = {"doc_id": [], "shingle": [], "classes": []}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), W.as_bytes(batch.column("text")), strict=True):
                shingles = document_set(text, numbers, widths)
                hit = in_bloom(bits, shingles)
                if hit.any():
                    mask = np.full(len(shingles), every, np.int64)
                    for q, each in sketches:
                        mask |= sketched(shingles, each).astype(np.int64) << q
                    found["doc_id"].append(np.full(hit.sum(), doc_id, np.int64))
                    found["shingle"].append(shingles[hit].view(np.int64))
                    found["classes"].append(mask[hit])
            if found["doc_id"]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v)) for v in found.values()], names=list(found)
                )

    return work


def _index(items: DataFrame) -> DataFrame:
    """(item_id, shingle, words, n_item, class) of all items."""
    rows = settle(
        items.where("item_id is not null")
        .select(F.col("item_id").cast("bigint").alias("item_id"), "text")
        .mapInArrow(_item_shingles, "item_id bigint, shingle bigint, words int")
        .distinct()
    )
    sizes = rows.groupBy("item_id").agg(F.count("*").alias("n_item"))
    power = F.length(F.bin("n_item")) - SHORT.bit_length() + 1
    return settle(rows.join(sizes, "item_id").withColumn("class", F.when(F.col("n_item") < SHORT, 0).otherwise(power)))


def candidates(found: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, item_id): pairs that share a value of the document's sketch for the item's class."""
    return (
        found.where("classes <> 0").join(index.select("shingle", "item_id", "class"), "shingle")
        .where(F.expr("shiftright(classes, class) & 1 = 1"))
        .select("doc_id", "item_id").distinct()
    )


def contained(documents: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, n_item (its shingles), n_shared and containment, for every item of
    which a document holds `percent` or more."""
    index = _index(items)
    told = index.agg(
        F.count("*").alias("n"), F.collect_set(F.when(F.col("words") < W.WIDTH, F.col("words"))).alias("widths"),
        F.collect_set("class").alias("classes"),
    ).first()
    sent = documents.sparkSession.sparkContext.broadcast(bloom(index, bloom_size(told.n)))
    found = settle(
        documents.where("doc_id is not null")
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .mapInArrow(
            _document_shingles(sent, sorted(told.widths), sorted(told.classes), percent),
            "doc_id bigint, shingle bigint, classes bigint",
        )
        .groupBy("doc_id", "shingle").agg(F.bit_or("classes").alias("classes"))
    )
    # Only candidates are looked up: a row for each of an item's shingles that a document may have.
    asked = settle(candidates(found, index)).join(index.select("item_id", "n_item", "shingle"), "item_id")
    return (
        asked.join(found.select("doc_id", "shingle"), ["doc_id", "shingle"])
        .groupBy("doc_id", "item_id")
        .agg(F.max("n_item").alias("n_item"), F.count("*").alias("n_shared"))
        .where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
        .select("doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    )


def clean(documents: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no item, in their own columns."""
    leaked = contained(documents, items, percent).select("doc_id").distinct()
    return documents.join(leaked, "doc_id", "left_anti").select(documents.columns)
