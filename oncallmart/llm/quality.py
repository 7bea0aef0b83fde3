"""Document quality: histogram gradient-boosted trees over statistics of the text.

Trees are grown level by level on statistics cut into 32 bins: a level sums gradients and
hessians by node, statistic and bin, and each node takes the cut with the largest gain. The
model is a few arrays (statistic, cut and leaf value by tree and node), which a task walks
for all rows of a batch at once with numpy.

Fitting uses at most FIT_ROWS labelled documents, those with the least hash of their id (the
documented bound); scoring covers every document. Inputs are statistics of the text alone. A
document with several labels counts as good only if all say so; null labels don't count. A
null or empty text has statistics of zero and a score like any other. Without labels every
score is 0.5. Repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.llm.words import as_bytes

FIT_ROWS = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST_ROWS = 60, 4, 32, 0.2, 1.0, 10.0
STATISTICS = (
    "chars", "words", "word_length", "distinct_words", "top_word", "repeated_next", "longest_word",
    "lines", "distinct_lines", "letters", "digits", "upper", "spaces", "stops", "symbols", "high_bytes",
    "end_symbols", "packed", "distinct_pairs", "byte_kinds", "byte_entropy", "vowels", "bars",
)
RESULT = "doc_id bigint, held_out boolean, score double, predicted int"


def _kinds(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


LOWER, DIGIT, UPPER = (_kinds(c) for c in (b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
SPACE, STOP, VOWEL = (_kinds(c) for c in (b" \t\n\r\x0b\x0c", b".,;:!?'\"()-", b"aeiouAEIOU"))
SYMBOL = _kinds(bytes(range(33, 127))) & ~(LOWER | DIGIT | UPPER | STOP)


def statistics(text: bytes | None) -> list[float]:
    """Numbers that describe a text, in the order of STATISTICS."""
    if not text:
        return [0.0] * len(STATISTICS)
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n = max(len(words), 1)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    pairs = list(zip(words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = counts[counts > 0] / size
    letters = counts[LOWER | UPPER].sum()
    return [
        float(size), float(len(words)), size / n, len(seen) / n, max(seen.values(), default=0) / n,
        sum(a == b for a, b in pairs) / n, float(max(map(len, words), default=0)),
        float(len(lines)), len(set(lines)) / max(len(lines), 1),
        letters / size, counts[DIGIT].sum() / size, counts[UPPER].sum() / size, counts[SPACE].sum() / size,
        counts[STOP].sum() / size, counts[SYMBOL].sum() / size, counts[128:].sum() / size,
        sum(c for w, c in seen.items() if SYMBOL[w[-1]]) / n, len(zlib.compress(text, 1)) / size,
        len(set(pairs)) / n, float(len(share)), float(-(share * np.log2(share)).sum()),
        counts[VOWEL].sum() / max(letters, 1), counts[ord("|")] / n,
    ]


@dataclass
class Model:
    """Trees as arrays [tree, node]; node k's children are 2k+1 and 2k+2. A value goes right
    if it is greater than the cut. A node that was not split sends all rows left."""

    statistic: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for statistic, cut, leaf in zip(self.statistic, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, statistic[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boosted trees for 0/1 labels by logistic loss. Ties go to the first statistic and cut."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    model = Model(
        np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, leaves)), 0.0
    )
    if not len(y) or y.min() == y.max():
        # One class only: its smoothed share.
        share = (y.sum() + 1) / (len(y) + 2)
        model.base = float(np.log(share / (1 - share)))
        return model
    model.base = float(np.log(y.mean() / (1 - y.mean())))
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    n, width = x.shape
    total = np.full(n, model.base)
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            place = ((node - first)[:, None] * width + np.arange(width)) * BINS + binned
            shape = (count, width, BINS)
            size = count * width * BINS
            sums = [
                np.bincount(place.ravel(), np.repeat(v, width), size).reshape(shape).cumsum(axis=2)
                for v in (g, h, np.ones(n))
            ]
            whole = [s[:, :, -1:] for s in sums]
            gain = (
                sums[0] ** 2 / (sums[1] + RIDGE)
                + (whole[0] - sums[0]) ** 2 / (whole[1] - sums[1] + RIDGE)
                - whole[0] ** 2 / (whole[1] + RIDGE)
            )
            gain[(sums[2] < LEAST_ROWS) | (whole[2] - sums[2] < LEAST_ROWS)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                s, b = divmod(int(best[k]), BINS)
                if gain[k, s, b] > 1e-6 and b < len(cuts[s]):
                    model.statistic[tree, first + k] = s
                    model.cut[tree, first + k] = cuts[s][b]
            node = 2 * node + 1 + (x[np.arange(n), model.statistic[tree, node]] > model.cut[tree, node])
        at = node - inner
        value = RATE * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + RIDGE)
        model.leaf[tree] = value
        total += value[at]
    return model


def _statistics(batches):
    for batch in batches:
        rows = [statistics(t) for t in as_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"]
        )


def _fit(group: pa.Table) -> pa.Table:
    """The one bounded group of the sample, in a fixed order, to one row of arrays."""
    x = np.array(group.column("x").to_pylist(), np.float64).reshape(len(group), len(STATISTICS))
    y = group.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((y, *x.T))
    model = fit(x[order], y[order])
    return pa.table(
        {
            "statistic": pa.array([model.statistic.ravel()], pa.list_(pa.int64())),
            "cut": pa.array([model.cut.ravel()], pa.list_(pa.float64())),
            "leaf": pa.array([model.leaf.ravel()], pa.list_(pa.float64())),
            "base": pa.array([model.base]),
        }
    )


def held_out(key: str = "doc_id"):
    """The fold that fitting never sees: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from a bounded sample of the labelled documents outside the held-out fold."""
    marked = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    # At most fit_rows rows of two numbers, so the labels go to the documents.
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        F.broadcast(marked), "doc_id"
    )
    # A doc_id may repeat, so the rows are bounded once more.
    sample = (
        rows.select("label", "text").mapInArrow(_statistics, "label int, x array<double>").limit(fit_rows)
    )
    found = (
        sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(
            _fit, "statistic array<bigint>, cut array<double>, leaf array<double>, base double"
        ).collect()
    )
    if not found:
        return fit(np.empty((0, len(STATISTICS))), np.empty(0))
    row, inner = found[0], 2**DEPTH - 1
    return Model(
        np.array(row.statistic).reshape(TREES, inner), np.array(row.cut).reshape(TREES, inner),
        np.array(row.leaf).reshape(TREES, inner + 1), row.base,
    )


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""

    def work(batches):
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            x = np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), len(STATISTICS))
            p = model.score(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                    pa.array((p >= 0.5).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(work, RESULT)


def score_documents(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    return score(documents, train(documents, labels, fit_rows))


def keep_good(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents that the classifier does not reject, in their own columns."""
    model = train(documents, labels, fit_rows)

    def work(batches):
        for batch in batches:
            rows = [statistics(t) for t in as_bytes(batch.column("text"))]
            x = np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))
            yield batch.filter(pa.array(model.score(x) >= 0.5))

    return documents.mapInArrow(work, documents.schema)
