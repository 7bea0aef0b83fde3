import itertools
import random
import re
from collections import Counter, defaultdict

from oncallmart.llm import filter_audit as A
from oncallmart.llm import queries


def mask_of(text, is_copy):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = (
        len(words) < 200, 100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), is_copy,
    )
    return "".join(k for k, f in zip("ABCDE", fails) if f)


def by_hand(docs, labels):
    """All steps by applying the filters to lists, order by order."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = defaultdict(list)
    for i, text, lang in docs:
        is_copy = i is not None and i > least[text or ""]
        parts[lang or ""].append((mask_of(text or "", is_copy), i in good, i in toxic))
    out = set()
    for part, rows in parts.items():
        removed_in = Counter()
        found = []
        for order in itertools.permutations("ABCDE"):
            left, before = rows, []
            for step, k in enumerate(order, 1):
                gone = [r for r in left if k in r[0]]
                left = [r for r in left if k not in r[0]]
                redundant = sum(k in r[0] for r in before)
                before = before + gone
                removed_in[k] += len(gone)
                found.append((
                    "".join(order), step, len(left), len(gone), redundant, sum(r[0] == k for r in rows),
                    sum(r[1] for r in gone), sum(r[2] for r in gone),
                ))
        out |= {(part, *f, removed_in[f[0][f[1] - 1]]) for f in found}
    return out


def rows_of(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    labels = spark.read.parquet(f"{small}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    want = by_hand([tuple(r) for r in docs], [tuple(r) for r in labels])
    assert rows_of(queries.QUERIES["op12_filter_audit"](spark, small)) == want


def test_swaps_pass_every_order_once():
    for n in range(1, 7):
        row = list(range(n))
        seen = [tuple(row)]
        for level in A.swaps(n):
            row[level], row[level + 1] = row[level + 1], row[level]
            seen.append(tuple(row))
        assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_diagram_keeps_counts_under_swaps():
    pick = random.Random(2)
    counts = {m: (pick.randrange(5), pick.randrange(3)) for m in range(16) if pick.random() < 0.6}
    diagram = A.Diagram(counts, 4, 2)
    for _ in range(60):
        diagram.swap(pick.randrange(3))
        for mask in range(16):
            at = diagram.root
            for k in diagram.order:
                at = diagram.children[at][mask >> k & 1]
            assert diagram.sums[at] == counts.get(mask, (0, 0))
        for k in range(4):
            assert diagram.failing(k) == tuple(sum(c[i] for m, c in counts.items() if m >> k & 1) for i in (0, 1))
            assert diagram.only(k) == counts.get(1 << k, (0, 0))
    # Equal parts of the diagram are one node.
    assert len(A.Diagram(dict.fromkeys(range(16), (1, 1)), 4, 2).children) == 5


def test_one_filter_and_no_documents():
    assert A.audit({0: (3, 1), 1: (2, 2)}, "X") == [("X", 1, 3, 2, 0, 2, 2, 2)]
    assert A.audit({}, "XY")[0] == ("XY", 1, 0, 0, 0, 0, 0)


LONG = " ".join(f"w{k}" for k in range(250))


def test_hard_rows(spark, hard, empty):
    pick = random.Random(9)
    extra = [(200 + k, pick.choice([LONG, LONG + " #", LONG.upper(), "w " * 300, "", None, "é" * 40]),
              pick.choice(["en", "de", None, ""])) for k in range(60)]
    extra += [extra[0], (None, LONG, "en"), (None, LONG, "en"), (None, "w " * 300, "de"), (1, LONG, "de")]
    rows = [(r.doc_id, r.text, r.lang) for r in hard.collect()] + extra
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "1 AS mask", "'x' AS part", "2 AS n", "3 AS good", "4 AS of")
    marks = [(k, pick.choice([0, 1, None]), pick.choice([0, 1, None])) for k in range(300) if pick.random() < 0.6]
    marks += [(None, 1, 1), (201, 1, 0), (201, 0, 1), (201, None, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "1 AS part")
    assert rows_of(A.filter_steps(docs, labels)) == by_hand(rows, marks)
    assert A.filter_steps(empty, labels).collect() == []
    assert rows_of(A.filter_steps(docs, labels.limit(0))) == by_hand(rows, [])


def test_texts_do_not_move(spark, hard):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = A.masks(hard, labels)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and "text#" not in " ".join(moved)
