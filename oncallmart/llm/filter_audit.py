"""What each filter removes in every order of the filters, by decision diagrams.

Every document has a mask of the filters that it fails. Documents are counted by part and
mask, and each part's counts become a decision diagram: one level a filter, each node with a
branch for passing and one for failing, leaves that hold the counts. Equal subdiagrams are
one node, and every node carries the sum of its leaves. Neighbouring levels are swapped by
regrouping the four grandchildren of each node of the upper level; a walk through all orders
in which each differs from the one before by one swap reaches every order. In an order, the
path of documents that pass all filters gives the steps: from a node to its passing child,
the failing child's sums are what the step removes.

The filters of the query, with words as longest runs of anything but ASCII white space:
A under 200 words; B fewer than half of the words distinct; C over 3 percent of the code
points in `[A-Z]`; D one of `#$%&*|` occurs; E some smaller doc_id has the same text.

A null text counts as empty. A null doc_id has no label, fails no E and makes no other fail
it; rows that repeat a doc_id are counted one by one, and with the same text none of them is
a copy of the other. Labels of one doc_id hold if any of its rows says 1; null labels say
nothing. A null part is the empty string. An empty table gives no rows. Further columns are
ignored, whatever their names.

Texts are read once and do not move: what moves and is stored are digests, flags and ids. The counts
behind E are added up by (text, part) before any shuffle by text, so that a text of a third
of all rows is one row a task; null ids, which no label fits, are dealt out by the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oncallmart.llm import words as W
from oncallmart.session import settle

FILTERS = "ABCDE"
COPY = FILTERS.index("E")
WEIGHTS = ("docs", "good", "toxic")
UPPER = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
# Bytes that begin no code point.
CONTINUING = bytes(range(0x80, 0xC0))
SLICE = 500


def text_failures(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()
    points = len(raw.translate(None, CONTINUING))
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * (len(raw) - len(raw.translate(None, UPPER))) > 3 * points,
        len(raw.translate(None, MARKS)) < len(raw),
    )
    return sum(1 << k for k, failed in enumerate(fails) if failed)


class Diagram:
    """Decision diagram of counts by mask. Nodes are numbers; `children[n]` is (passing,
    failing), `sums[n]` the total of the leaves below, with no levels left out."""

    def __init__(self, counts: dict[int, tuple[int, ...]], filters: int, weights: int):
        self.order = list(range(filters))
        self.children: list[tuple[int, int] | None] = []
        self.sums: list[tuple[int, ...]] = []
        self.known: dict = {}
        nothing = (0,) * weights

        def build(level: int, mask: int) -> int:
            if level == filters:
                return self.leaf(counts.get(mask, nothing))
            return self.node(build(level + 1, mask), build(level + 1, mask | 1 << level))

        self.root = build(0, 0)

    def _made(self, key, children, sums) -> int:
        if key not in self.known:
            self.known[key] = len(self.children)
            self.children.append(children)
            self.sums.append(sums)
        return self.known[key]

    def leaf(self, sums: tuple[int, ...]) -> int:
        return self._made(("leaf", *sums), None, sums)

    def node(self, passing: int, failing: int) -> int:
        total = tuple(a + b for a, b in zip(self.sums[passing], self.sums[failing], strict=True))
        return self._made((passing, failing), (passing, failing), total)

    def swap(self, level: int) -> None:
        """Exchange the filters of a level and the next."""
        done: dict[int, int] = {}

        def rebuilt(n: int, at: int) -> int:
            if n not in done:
                passing, failing = self.children[n]
                if at < level:
                    done[n] = self.node(rebuilt(passing, at + 1), rebuilt(failing, at + 1))
                else:
                    (pp, pf), (fp, ff) = self.children[passing], self.children[failing]
                    done[n] = self.node(self.node(pp, fp), self.node(pf, ff))
            return done[n]

        self.root = rebuilt(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(filter, sums kept, sums removed) of each level along the all-pass path."""
        at = self.root
        for k in self.order:
            at, failing = self.children[at]
            yield k, self.sums[at], self.sums[failing]

    def failing(self, k: int) -> tuple[int, ...]:
        """Sums over the documents that fail filter `k`, from the nodes of its level."""
        level, row = self.order.index(k), {self.root: 1}
        for _ in range(level):
            below: dict[int, int] = {}
            for n, ways in row.items():
                for child in self.children[n]:
                    below[child] = below.get(child, 0) + ways
            row = below
        totals = [0] * len(self.sums[self.root])
        for n, ways in row.items():
            for i, x in enumerate(self.sums[self.children[n][1]]):
                totals[i] += ways * x
        return tuple(totals)

    def only(self, k: int) -> tuple[int, ...]:
        """Sums over the documents that fail filter `k` alone."""
        at = self.root
        for other in self.order:
            passing, failing = self.children[at]
            at = failing if other == k else passing
        return self.sums[at]


def swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after another, so that all n! orders are passed once."""
    place, way = list(range(n)), [-1] * n
    # `row[i]` is the item at place i; an item moves the way it faces past smaller items.
    row = list(range(n))
    while True:
        movable = [x for x in row if 0 <= place[x] + way[x] < n and row[place[x] + way[x]] < x]
        if not movable:
            return
        x = max(movable)
        i, j = place[x], place[x] + way[x]
        row[i], row[j] = row[j], row[i]
        place[row[i]], place[row[j]] = i, j
        for y in range(x + 1, n):
            way[y] = -way[y]
        yield min(i, j)


def audit(counts: dict[int, tuple[int, ...]], names: Sequence[str] = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, *lost, shapley) for every order
    and step; `counts` maps masks to the number of documents and further counts, `lost` are
    the further counts that the step removes."""
    weights = len(next(iter(counts.values()), (0,)))
    diagram = Diagram(counts, len(names), weights)
    fails = [diagram.failing(k)[0] for k in range(len(names))]
    only = [diagram.only(k)[0] for k in range(len(names))]
    shapley, found = [0] * len(names), []

    def note() -> None:
        order = "".join(names[k] for k in diagram.order)
        for step, (k, kept, removed) in enumerate(diagram.steps(), 1):
            shapley[k] += removed[0]
            found.append((order, step, kept[0], removed[0], fails[k] - removed[0], only[k], *removed[1:], k))

    note()
    for level in swaps(len(names)):
        diagram.swap(level)
        note()
    return [(*row[:-1], shapley[row[-1]]) for row in found]


def flags(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text_md5, mask): masks of the filters that texts decide by themselves."""

    def work(batches):
        for batch in batches:
            for begin in range(0, len(batch), SLICE):
                rows = batch.slice(begin, SLICE)
                texts = [t or b"" for t in W.as_bytes(rows.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id"),
                        rows.column("part"),
                        pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                        pa.array([text_failures(t) for t in texts], pa.int32()),
                    ],
                    names=["doc_id", "part", "text_md5", "mask"],
                )

    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
    kept = T.StructType([rows.schema["doc_id"], T.StructField("part", T.StringType())])
    return rows.mapInArrow(work, kept.add("text_md5", T.BinaryType()).add("mask", T.IntegerType()))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents counted by part and failed filters."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("of")).agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("is_good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("is_toxic"),
    )
    # A mask of A to D belongs to a text, so it is the same in all rows of a digest.
    rows = flags(docs).groupBy("text_md5", "part", "doc_id").agg(
        F.first("mask").alias("mask"), F.count(F.lit(1)).alias("n")
    )
    deal = F.when(F.col("doc_id").isNull(), F.xxhash64("text_md5")).otherwise(0)
    known = rows.withColumn("deal", deal).join(
        marks.withColumn("none", F.lit(0).cast("long")),
        (F.col("doc_id") == F.col("of")) & (F.col("deal") == F.col("none")),
        "left",
    ).select(
        "text_md5", "part", "doc_id", "mask", "n",
        (F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"),
        (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"),
    )
    named = F.col("doc_id").isNotNull()
    by_text = settle(known.groupBy("text_md5", "part").agg(
        F.first("mask").alias("mask"),
        *(F.sum(w).alias(w) for w in ("n", "good", "toxic")),
        # A doc_id has one row here, so the least struct is that of the smallest doc_id.
        F.min(F.when(named, F.struct("doc_id", "n", "good", "toxic"))).alias("least"),
        *(F.sum(F.when(~named, F.col(w)).otherwise(0)).alias(f"free_{w}") for w in ("n", "good", "toxic")),
    ))
    smallest = by_text.groupBy(F.col("text_md5").alias("text")).agg(F.min("least.doc_id").alias("smallest"))
    held = by_text.join(smallest, F.col("text_md5") == F.col("text"))
    first = F.coalesce(F.col("least.doc_id") == F.col("smallest"), F.lit(False))
    passing = [
        (F.col(f"free_{w}") + F.when(first, F.col(f"least.{w}")).otherwise(0)).alias(w) for w in ("n", "good", "toxic")
    ]
    both = held.select("part", "mask", "n", "good", "toxic", F.struct(*passing).alias("ok")).select(
        "part",
        F.explode(
            F.array(
                F.struct("mask", *(F.col(f"ok.{w}").alias(w) for w in ("n", "good", "toxic"))),
                F.struct(
                    F.col("mask").bitwiseOR(1 << COPY).alias("mask"),
                    *((F.col(w) - F.col(f"ok.{w}")).alias(w) for w in ("n", "good", "toxic")),
                ),
            )
        ).alias("at"),
    )
    return both.where("at.n > 0").groupBy("part", F.col("at.mask").alias("mask")).agg(
        F.sum("at.n").alias("docs"), F.sum("at.good").alias("good"), F.sum("at.toxic").alias("toxic")
    )


STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def interactions(counted: DataFrame, names: str = FILTERS) -> DataFrame:
    """Steps of every order for each part of (part, mask, docs, good, toxic). A part has at
    most as many rows as there are masks, so it is worked on in one piece."""

    def work(batches):
        for batch in batches:
            out = []
            for part, held in zip(batch.column("part").to_pylist(), batch.column("held").to_pylist(), strict=True):
                counts = {h["mask"]: tuple(h[w] for w in WEIGHTS) for h in held}
                out += [(part, *row) for row in audit(counts, names)]
            kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
            columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in STEPS.split(", ")],
            )

    grouped = counted.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("held"))
    return grouped.mapInArrow(work, STEPS)


def filter_steps(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(settle(masks(docs, labels)))
