"""Codes of vectors: one codebook entry for each of their parts, in exact integers.

Each component becomes floor(scale * x). Vectors are cut into equal consecutive parts, and
each part's codebook starts as that part of the vectors with the smallest ids. A round
assigns every part to the nearest entry (squared Euclidean distance, the first of equals)
and replaces each entry by the floor of its parts' mean; an entry without parts stays.

Distances come from a matrix product, which numpy does fast only in floating point. So the
integers are split into limbs small enough that a sum of products of two limbs stays below
2^53 and is exact in float64; the products are shifted and added as 64-bit integers. Where
even a distance could pass 2^62, Python's own integers are used; an error beyond a long
raises ArithmeticError, as do components beyond 2^62 after scaling.

Each task adds up its parts by entry and gives one row an entry, so only sums by entry are
shuffled and reach the driver: `parts * entries` rows, whatever the input.

Rows are dropped whose vector is null, holds a null or a component that is not finite, or
has another length than most (of equally frequent lengths the smallest counts); a length
that `parts` does not divide is refused. Rows with a null id are coded, but start no
codebook; of rows with one id the one with the smaller integers comes first. Repeated rows
are coded one by one. With fewer vectors than entries the codebooks are smaller; an empty
table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oncallmart.session import settle

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# So many distinct labels have their sums sent to every task; more are joined in salted parts.
FEW_LABELS, SALTS = 10_000, 16
# Vectors in one matrix product.
SLICE = 4096


def limb_bits(width: int) -> int:
    """Bits of a limb so that `width` products of two limbs add up to at most 2^53."""
    return (53 - max(width - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays whose sum, each shifted by `bits` more than the one before, is `x`; all
    but the last hold 0 to 2^bits - 1, the last is at most 2^bits in size."""
    out = []
    while x.size and max(int(x.max()), -int(x.min())) > 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def dot(x: np.ndarray, y: np.ndarray, bits: int | None = None) -> np.ndarray:
    """x @ y.T of int64 matrices, exact where the results fit 64 bits."""
    bits = bits or limb_bits(x.shape[1])
    total = np.zeros((len(x), len(y)), np.int64)
    pieces = limbs(y, bits)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(pieces):
            total += (a @ b.T).astype(np.int64) << (bits * (i + j))
    return total


def _largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest entry of each row, and the squared distance to it."""
    apart = _largest(x) + _largest(entries)
    if apart * apart * x.shape[1] >= 1 << 62:
        apart = x.astype(object)[:, None, :] - entries.astype(object)[None]
        far = (apart * apart).sum(axis=2)
        # Arrays of objects have no reliable argmin.
        first = np.array([min(range(len(row)), key=row.__getitem__) for row in far], np.int64)
        return first, far[np.arange(len(x)), first]
    own = (x * x).sum(axis=1)
    far = (entries * entries).sum(axis=1)[None] - 2 * dot(x, entries)
    first = far.argmin(axis=1)
    return first, far[np.arange(len(x)), first] + own


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, length)


def _slices(batches, length: int):
    for batch in batches:
        for begin in range(0, len(batch), SLICE):
            part = batch.slice(begin, SLICE)
            yield part, _matrix(part.column("ints"), length)


def integers(vectors: DataFrame, ident: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, ints) of the rows whose vector is whole; floor(scale * x) saturates at the
    ends of a long, which `fit` refuses."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad).select(
        F.col(ident).alias("vec_id"),
        F.col(label).alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("ints"),
    )


def usual_length(whole: DataFrame) -> int | None:
    found = whole.groupBy(F.size("ints").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.n if found else None


def first_entries(whole: DataFrame, length: int, parts: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, place) of the rows with the smallest ids."""
    first = whole.where("vec_id IS NOT NULL").orderBy("vec_id", "ints").limit(entries).collect()
    books = np.array([r.ints for r in first], np.int64).reshape(-1, parts, length // parts)
    return books.transpose(1, 0, 2)


def sums_by_entry(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """(slot, n, s0, s1, ...): parts assigned to each entry and the sums of their places."""
    parts, entries, width = books.shape

    def work(batches):
        counts = np.zeros(parts * entries, np.int64)
        totals = np.zeros((parts * entries, width), object)
        for _, x in _slices(batches, parts * width):
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                slots = nearest(part, books[p])[0] + p * entries
                counts += np.bincount(slots, minlength=len(counts))
                if _largest(part) < 1 << 40:
                    # A slice's sums stay far below 2^63.
                    added = np.zeros(totals.shape, np.int64)
                    np.add.at(added, slots, part)
                    used = np.unique(slots)
                    totals[used] += added[used].astype(object)
                else:
                    np.add.at(totals, slots, part.astype(object))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array(counts[used], pa.int64()),
                *(pa.array([Decimal(int(v)) for v in totals[used, i]], pa.decimal128(38, 0)) for i in range(width)),
            ],
            names=["slot", "n", *(f"s{i}" for i in range(width))],
        )

    shape = ", ".join(["slot int", "n bigint", *(f"s{i} decimal(38,0)" for i in range(width))])
    return (
        whole.select("ints").mapInArrow(work, shape).groupBy("slot")
        .agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").cast("decimal(38,0)").alias(f"s{i}") for i in range(width)))
    )


def moved(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = books.shape
    out = books.copy()
    for r in sums_by_entry(whole, books).collect():
        out[r.slot // entries, r.slot % entries] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return out


def fit(
    vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray | None]:
    """The whole rows as stored integers, and their codebooks (None without rows)."""
    if not 1 <= entries <= 256:
        raise ValueError("an index takes two hex digits: 1 to 256 entries")
    whole = settle(integers(vectors, ident, vector, label, scale))
    length = usual_length(whole)
    if length is None:
        return whole, None
    if length % parts:
        raise ValueError(f"{parts} parts do not divide vectors of {length}")
    whole = whole.where(F.size("ints") == length)
    widest = whole.agg(F.max(F.array_max("ints")).alias("high"), F.min(F.array_min("ints")).alias("low")).first()
    if max(widest.high, -widest.low) > 1 << 62:
        raise ArithmeticError("a component is too large for exact 64-bit codes")
    books = first_entries(whole, length, parts, entries)
    if not books.size:
        return whole.limit(0), None
    for _ in range(rounds):
        books = moved(whole, books)
    return whole, books


def assign(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): indexes of the nearest entries in two hex digits each, and
    the sum of the squared distances to them."""
    parts, _, width = books.shape

    def work(batches):
        for part, x in _slices(batches, parts * width):
            codes = np.empty((len(x), parts), np.uint8)
            errors = np.zeros(len(x), object)
            for p in range(parts):
                codes[:, p], far = nearest(x[:, p * width : (p + 1) * width], books[p])
                errors += far
            if len(x) and max(errors) >= 1 << 63:
                raise ArithmeticError("an error is beyond a long")
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("vec_id"),
                    part.column("label"),
                    pa.array([text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()),
                    pa.array([int(e) for e in errors], pa.int64()),
                ],
                names=["vec_id", "label", "code", "error"],
            )

    kept = T.StructType([whole.schema["vec_id"], whole.schema["label"]])
    return whole.mapInArrow(work, kept.add("code", "string").add("error", "long"))


def restored(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(vec_id, vector): the entries that each code names, in the unit of the vectors."""
    parts = len(books)

    def work(batches):
        for batch in batches:
            raw = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, parts)
            rows = np.concatenate([books[p][raw[:, p]] for p in range(parts)], axis=1) / scale
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["vec_id", "vector"]
            )

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(work, f"vec_id {kind}, vector array<double>")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the error summed over equal labels, nulls together. The sums are sent to every
    task if there are few of them, else met in `SALTS` parts a label."""
    coded = settle(coded)
    sums = settle(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    if sums.count() <= FEW_LABELS:
        return coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS))
    dealt = sums.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("part"))
    return coded.withColumn("salt", salt).join(dealt, same).drop("of", "part", "salt")


def codes(vectors: DataFrame) -> DataFrame:
    """Code, error, error of the label and the codebooks' digest of every whole vector."""
    whole, books = fit(vectors)
    if books is None:
        kind = whole.schema["vec_id"].dataType.simpleString()
        shape = f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
        return whole.sparkSession.createDataFrame([], shape)
    return with_label_error(assign(whole, books)).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
