"""Personal data by weak supervision, with DataFrame functions only.

Candidates are the matches of a strict pattern for each kind, whether or not they pass their
check, and of looser patterns (obfuscated addresses, numbers with other separators). Five
labelers vote on each: the pattern, the check (Luhn, number ranges, digit counts), a
gazetteer (top-level domains, issuer and calling codes), words before it, and its borders.
Candidates are counted by kind and votes, at most 4 * 3^5 rows, and expectation-maximisation
on these estimates each labeler's reliability. The resulting probabilities train the final
classifier, naive Bayes over kind, votes, length and digits of the span.

Strict matches that pass their check are always spans. A looser candidate is one if it passes
its check, overlaps no strict span, and the classifier gives it a half or more.

Positions are code points, the end exclusive. A null or empty text has no spans. Rows are
handled one by one, so repeated rows and equal or null ids are fine; further columns are
ignored. Without any candidate the classifier is not needed. Patterns use single-character
loops only, because the matcher's group loops would exhaust the stack on very long matches;
for that, separators inside a match are first replaced by one reserved character each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncallmart.session import settle

KINDS = ["email", "ip", "card", "phone"]
VOTES = ["pattern", "check", "gazetteer", "words", "borders"]
ROUNDS, SMOOTHING = 12, 1.0
CANDIDATE = (
    "struct<kind:int,begin:bigint,end:bigint,strict:boolean,valid:boolean,pattern:int,check:int,"
    "gazetteer:int,words:int,borders:int,length:int,digits:int>"
)
# Separators inside a card number and dots inside a domain, as reserved characters.
CARD_MARK, DOT_MARK = "\u0001", "\u0003"
STRICT = {
    "email": (
        rf"(?:\G|(?<![A-Za-z0-9._%+{DOT_MARK}-]))[A-Za-z0-9._%+{DOT_MARK}-]++@"
        rf"[A-Za-z0-9-]++{DOT_MARK}[A-Za-z0-9{DOT_MARK}-]++"
    ),
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": rf"[0-9][0-9{CARD_MARK}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64} ?[\[(] ?(?i:at) ?[\])] ?[A-Za-z0-9-]{1,63} ?[\[(] ?(?i:dot) ?[\])] ?[A-Za-z]{2,24}",
    "card": r"(?<![0-9])[0-9]{4}([./_])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
# What a text must have for a pattern to be tried.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
LOOSE_HINT = {"email": r"[\[(] ?(?i:at) ?[\])]", "card": r"[0-9]{4}[./_][0-9]{4}", "phone": r"[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}"}
# Gazetteers and context words; fixed values.
DOMAINS = "com org net edu gov mil int info biz io eu uk us de fr es it nl be ch at pt pl se no dk fi br mx ar ca au jp cn in".split()
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6)"
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CONTEXT = {
    "email": "(?i)mail|contact|write|correo|courriel|schreib",
    "ip": "(?i)\\bip\\b|address|host|server|login|direcci|adresse",
    "card": "(?i)card|visa|master|credit|tarjeta|carte|karte",
    "phone": "(?i)phone|call|tel|mobile|fax|llam|appel|anruf",
}


def let(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether 13 to 19 digits pass the Luhn check."""
    n = F.length(digits)

    def add(total, k):
        d = F.substring(digits, n - k, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(k % 2 == 1, twice).otherwise(d)

    return F.when(
        n.between(13, 19), F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0
    ).otherwise(False)


def check(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return let(digits_of(match), luhn)
    if kind == "phone":
        return F.length(digits_of(match)).between(9, 15)
    return F.lit(True)


def vote(yes: Column) -> Column:
    return F.when(yes, 1).otherwise(-1)


def gazetteer(kind: str, match: Column) -> Column:
    if kind == "email":
        return vote(F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1)).isin(DOMAINS))
    if kind == "ip":
        return vote(~match.rlike(r"^0*(?:0|22[4-9]|2[3-5][0-9])\."))
    if kind == "card":
        return vote(match.rlike(ISSUERS))
    return F.when(match.startswith("+"), vote(match.rlike(CALLING))).otherwise(0)


def matches(text: Column, kind: str, pattern: str, hint: str, strict: bool) -> Column:
    """Candidates of one pattern, as an array of CANDIDATE.

    The pieces between matches give the positions: a match begins after the lengths of all
    pieces and matches before it. Sums over blocks of 256 keep that from growing with the
    square of the number of matches.
    """
    nothing = F.array().cast(f"array<{CANDIDATE}>")

    def place(found):
        pieces, texts = found["pieces"], found["texts"]
        n = F.size(texts)
        lengths = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.length(pieces[i]) + F.length(texts[i]))

        def total(values):
            return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)

        def with_lengths(each):
            blocks = F.transform(
                F.sequence(F.lit(0), F.floor((n - 1) / 256).cast("int")),
                lambda b: total(F.slice(each, b * 256 + 1, F.lit(256))),
            )

            def with_blocks(sums):
                befores = F.transform(
                    F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, F.lit(1), b))
                )
                return let(befores, lambda before: F.transform(F.sequence(F.lit(0), n - 1), lambda i: one(each, before, i)))

            return let(blocks, with_blocks)

        def one(each, before, i):
            block = F.floor(i / 256).cast("int")
            begin = before[block] + total(F.slice(each, block * 256 + 1, i % 256)) + F.length(pieces[i])
            match = texts[i]
            valid = check(kind, match)
            free = ~(F.right(pieces[i], F.lit(1)).rlike("[A-Za-z0-9]") | F.left(pieces[i + 1], F.lit(1)).rlike("[A-Za-z0-9]"))
            return let(
                valid,
                lambda ok: F.struct(
                    F.lit(KINDS.index(kind)).alias("kind"), begin.alias("begin"), (begin + F.length(match)).alias("end"),
                    (ok if strict else F.lit(False)).alias("strict"), ok.alias("valid"),
                    F.lit(1 if strict else -1).alias("pattern"), vote(ok).alias("check"),
                    gazetteer(kind, match).alias("gazetteer"),
                    F.when(F.right(pieces[i], F.lit(24)).rlike(CONTEXT[kind]), 1).otherwise(0).alias("words"),
                    vote(free).alias("borders"),
                    F.least(F.floor(F.length(match) / 4), F.lit(8)).cast("int").alias("length"),
                    F.least(F.floor(F.length(digits_of(match)) / 3), F.lit(7)).cast("int").alias("digits"),
                ).cast(CANDIDATE),
            )

        return F.when(n > 0, let(lengths, with_lengths)).otherwise(nothing)

    found = F.struct(
        F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("texts")
    )
    return F.when(text.rlike(hint), let(found, place)).otherwise(nothing)


def candidates(text: Column) -> Column:
    """All candidates of a text column; loose ones only where no strict span lies."""
    plain = F.translate(F.coalesce(text, F.lit("")), CARD_MARK + DOT_MARK, "\u0002\u0002")

    def strict(t):
        marked = {
            "email": F.when(F.contains(t, F.lit("@")), F.regexp_replace(t, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT_MARK)).otherwise(""),
            "card": F.when(t.rlike("[0-9]"), F.regexp_replace(t, "(?<=[0-9])[ -](?=[0-9])", CARD_MARK)).otherwise(""),
        }

        def of(kind):
            return lambda m: matches(m, kind, STRICT[kind], HINT[kind], True)

        return F.concat(*(let(marked[k], of(k)) if k in marked else of(k)(t) for k in KINDS))

    def both(t):
        loose = F.concat(*(matches(t, k, LOOSE[k], LOOSE_HINT[k], False) for k in LOOSE))

        def free(found):
            taken = F.filter(found, lambda s: s["strict"])
            return F.concat(
                found,
                F.filter(loose, lambda x: ~F.exists(taken, lambda s: (s["begin"] < x["end"]) & (x["begin"] < s["end"]))),
            )

        return let(strict(t), free)

    return let(plain, both)


FEATURES = [*VOTES, "kind", "length", "digits"]


def reliabilities(counts: DataFrame, rounds: int = ROUNDS) -> tuple[float, dict]:
    """Share of true candidates, and P(vote | truth) of every labeler, from counted votes.

    Each round is one aggregate over the counted votes; only its sums come back.
    """
    posterior = sum((F.col(v) for v in VOTES), F.lit(0))
    posterior = F.when(posterior > 0, 0.9).when(posterior < 0, 0.1).otherwise(0.5)
    prior, table = 0.5, {}
    for _ in range(rounds):
        weighted = counts.withColumn("p", posterior)
        sums = weighted.agg(
            F.sum(F.col("n") * F.col("p")).alias("true"), F.sum("n").alias("all"),
            *(
                F.sum(F.when(F.col(v) == value, F.col("n") * (F.col("p") if truth else 1 - F.col("p"))).otherwise(0.0)).alias(f"{v}_{value}_{truth}")
                for v in VOTES for value in (-1, 0, 1) for truth in (0, 1)
            ),
        ).first()
        if not sums["all"]:
            return 0.5, {}
        sizes = {1: sums["true"], 0: sums["all"] - sums["true"]}
        prior = (sizes[1] + SMOOTHING) / (sums["all"] + 2 * SMOOTHING)
        table = {
            (v, value, truth): (sums[f"{v}_{value}_{truth}"] + SMOOTHING) / (sizes[truth] + 3 * SMOOTHING)
            for v in VOTES for value in (-1, 0, 1) for truth in (0, 1)
        }
        odds = F.lit(math.log(prior / (1 - prior)))
        for v in VOTES:
            weight = {x: math.log(table[v, x, 1] / table[v, x, 0]) for x in (-1, 0, 1)}
            odds = odds + F.when(F.col(v) == 1, weight[1]).when(F.col(v) == 0, weight[0]).otherwise(weight[-1])
        posterior = 1 / (1 + F.exp(-odds))
    return prior, {"table": table, "posterior": posterior}


def train(found: DataFrame) -> dict:
    """Log-odds weights (feature, value) of the final classifier, from candidate arrays.

    The counted rows are bounded by the kinds, votes, lengths and digits there are, whatever
    the number of documents."""
    counts = settle(
        found.where("size(candidates) > 0").select(F.explode("candidates").alias("c")).select("c.*")
        .groupBy(*FEATURES).agg(F.count("*").alias("n"))
    )
    prior, fitted = reliabilities(counts.groupBy(*VOTES).agg(F.sum("n").alias("n")))
    if not fitted:
        return {}
    labelled = counts.withColumn("p", fitted["posterior"])
    rows = (
        labelled.select(
            "n", "p", F.explode(F.map_from_arrays(F.array(*map(F.lit, FEATURES)), F.array(*FEATURES))).alias("feature", "value")
        )
        .groupBy("feature", "value")
        .agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
        .collect()
    )
    yes = sum(r.yes for r in rows if r.feature == "kind")
    no = sum(r.no for r in rows if r.feature == "kind")
    kinds = {f: sum(r.feature == f for r in rows) for f in FEATURES}
    weights = {
        (r.feature, r.value): math.log((r.yes + SMOOTHING) / (yes + SMOOTHING * kinds[r.feature]))
        - math.log((r.no + SMOOTHING) / (no + SMOOTHING * kinds[r.feature]))
        for r in rows
    }
    return {"prior": math.log(prior / (1 - prior)), "weights": weights}


def probability(model: dict, candidate: Column) -> Column:
    odds = F.lit(model["prior"]) if model else F.lit(0.0)
    for feature in FEATURES if model else []:
        own = {v: w for (f, v), w in model["weights"].items() if f == feature}
        weight = F.lit(0.0)
        for value, w in own.items():
            weight = F.when(candidate[feature] == value, F.lit(w)).otherwise(weight)
        odds = odds + weight
    return 1 / (1 + F.exp(-odds))


def chosen(model: dict, found: Column) -> Column:
    """Spans among the candidates, by kind, then begin."""
    kept = F.filter(found, lambda c: c["strict"] | (c["valid"] & (probability(model, c) >= 0.5)))
    return F.array_sort(F.transform(kept, lambda c: F.struct(c["kind"].alias("kind"), c["begin"].alias("begin"), c["end"].alias("end"), c["strict"].alias("strict"))))


def listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["begin"].cast("string"), s["end"].cast("string"))))


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, the number of strict spans of each kind, their digest, and all spans."""
    found = settle(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), candidates(F.col("text")).alias("candidates")))
    model = train(found)
    spans = found.select("doc_id", chosen(model, F.col("candidates")).alias("spans"))
    strict = F.filter("spans", lambda s: s["strict"])
    return spans.select(
        "doc_id",
        *(
            F.size(F.filter(strict, lambda s: s["kind"] == KINDS.index(name))).cast("bigint").alias(f"n_{name}")  # noqa: B023
            for name in KINDS
        ),
        F.sha2(listed(strict), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def redact(documents: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind, as in `<email>`; overlapping spans
    become one. Other columns stay; n_chars, where there is one, is the new length."""
    model = train(documents.select(candidates(F.col("text")).alias("candidates")))
    names = F.array(*map(F.lit, KINDS))

    def replaced(text):
        spans = F.array_sort(
            F.transform(chosen(model, candidates(text)), lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind")))
        )
        start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

        def add(state, s):
            fresh = s["begin"] >= state["at"]
            gap = F.substring(text, (state["at"] + 1).cast("int"), (s["begin"] - state["at"]).cast("int"))
            return F.struct(
                F.when(fresh, F.concat(state["done"], gap, F.lit("<"), names[s["kind"]], F.lit(">"))).otherwise(state["done"]).alias("done"),
                F.greatest(state["at"], s["end"]).alias("at"),
            )

        return F.when(text.rlike(r"[0-9@]|[\[(] ?(?i:at)"), let(
            spans,
            lambda all_: F.when(
                F.size(all_) > 0,
                let(F.aggregate(all_, start, add), lambda x: F.concat(x["done"], F.substring(text, (x["at"] + 1).cast("int"), F.length(text)))),
            ).otherwise(text),
        )).otherwise(text)

    out = documents.withColumn("text", replaced(F.col("text")))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out.select(documents.columns)
