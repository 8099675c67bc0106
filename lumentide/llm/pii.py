"""Personal data by candidate gradient boosting.

High-recall generators propose spans, which may overlap: the four base kinds, and forms that the
base patterns do not cover (e-mail addresses spelled out, national phone numbers, social security
numbers, IBANs, IPv6 addresses).  Each candidate has format and context features.  Boosted trees
learn from candidates with a check of their own (check digits, ranges) to tell real ones from
lookalikes by format and context alone: the check labels and is no feature.  A lookalike passes
now and then, so of those that pass as many count as lookalikes as the failures make likely.  A
threshold for each kind, calibrated on held-out candidates, selects among those that pass.  The base
spans are fixed by rule and always stay; selected spans that overlap no base span and no better
one are added.

All work on rows is DataFrame functions.  Texts are read once, by patterns that run in linear
time (possessive, and anchored where a run begins).  Matches are rows from there on: their places
and overlaps come from running sums and maxima in windows over a text's matches, so the time
grows with a text's matches and not with their square.  Features are small integers, so the
training rows are counted by feature vector in Spark and the trees grow on those few counts.

A few made-up counts (``PRIOR``) go with those of the corpus, by which a candidate glued to what
stands before it is a lookalike and one that stands alone is real; they decide where the corpus
has no candidates of one of the classes, and weigh nothing where it has many.

Semantics: a null text is empty; positions are code points, ends exclusive; rows that repeat are
documents of their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch

#: Kinds in the order of spans that begin alike.
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "ip6")
BASE = KINDS[:4]
#: Generators: kind, pattern, characters one of which a text must hold.  The first four are the base patterns; the
#: card pattern takes only runs of 12 to 19 digits, which are the ones that can pass.
GENERATORS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    ("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])", ""),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    ("email", r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({]at[\])}] ?[A-Za-z0-9-]{1,63}+ ?(?:\.|[\[({]dot[\])}]) ?[A-Za-z]{2,24}+(?![A-Za-z0-9])", "[({"),
    ("phone", r"(?<![0-9+.-])(?:\([0-9]{2,4}\)[\x20-]?|[0-9]{3}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{4}(?![0-9-]|\.[0-9])", ""),
    ("ssn", r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]|\.[0-9])", "-"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])", ""),
    ("ip6", r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])", ":"),
)
#: Context words that speak for personal data, in the characters before a span.
CUES = "mail|contact|write|phone|tel|call|mobile|fax|card|visa|pay|iban|account|konto|ssn|social|address|host|server|ip"
BEFORE = 32
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

ROUNDS, RATE, PRECISION = 24, 0.4, 0.95


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    marks = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(i % 2 == 0, F.try_element_at(F.array(*map(F.lit, range(10))), x.try_cast("int") + 1)).otherwise(F.try_element_at(F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), x.try_cast("int") + 1)))
    return F.aggregate(marks, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod97(s: Column) -> Column:
    """Whether an IBAN passes its check: letters are 10 to 35, the first four characters go last."""
    flat = F.replace(s, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(flat, 5, 99), F.substring(flat, 1, 4)), "")
    value = lambda x: F.when(x.rlike("[0-9]"), x.try_cast("int")).otherwise(F.ascii(x) - 55)
    return F.aggregate(F.filter(turned, lambda x: x != ""), F.lit(0), lambda a, x: F.when(x.rlike("[0-9]"), (a * 10 + value(x)) % 97).otherwise((a * 100 + value(x)) % 97)) == 1


def _valid(kind: str, s: Column) -> Column:
    digits = _digits(s)
    if kind == "ip":
        return s.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "ssn":
        return ~s.rlike("^(?:000|666|9..)|-00-|-0000$")
    if kind == "iban":
        return mod97(s)
    return F.lit(True)


def _found(text: Column, number: int) -> Column:
    """array<struct> of the candidates of one generator."""
    kind, pattern, needs = GENERATORS[number]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if needs:
        some = F.lit(False)
        for c in needs:
            some = some | F.contains(text, F.lit(c))
        matches = F.when(some, matches).otherwise(F.array().cast("array<string>"))
    return matches


#: Kinds whose check tells lookalikes and is not restated by a feature, and the share of lookalikes that pass it:
#: an octet of three random digits, a check digit, the ranges of random digits, two check digits.
CHANCE = {"ip": 0.256, "card": 0.1, "ssn": 0.89, "iban": 1 / 97}
FEATURES = ("generator", "valid", "digits", "groups", "cue", "glued", "letters", "wide")
#: What the trees of ``train`` may split by: format and context, not the check nor what tells kinds with one from those without.
LEARNT = tuple(f for f in FEATURES if f not in ("generator", "valid"))


def _matches(docs: DataFrame) -> DataFrame:
    """row (a number of its own), doc_id and hits: generator, i (its how many-eth), skipped (characters since the one before), s (the match), before."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", text.alias("text"))
    n = range(len(GENERATORS))
    out = out.select("doc_id", "text", *[_found(F.col("text"), i).alias(f"m{i}") for i in n])
    # a text is only cut into pieces where there is a match
    out = out.select("doc_id", *[f"m{i}" for i in n], *[F.when(F.size(f"m{i}") > 0, F.split("text", GENERATORS[i][1], -1)).otherwise(F.array().cast("array<string>")).alias(f"p{i}") for i in n])

    def hits(g: int) -> Column:
        pairs = F.filter(F.arrays_zip(F.col(f"p{g}").alias("p"), F.col(f"m{g}").alias("m")), lambda x: x["m"].isNotNull())
        return F.transform(pairs, lambda x, i: F.struct(F.lit(g).alias("generator"), i.alias("i"), F.length(x["p"]).cast("long").alias("skipped"), x["m"].alias("s"), F.lower(F.right(x["p"], F.lit(BEFORE))).alias("before")))

    return out.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*map(hits, n)).alias("hits"))


def _described(matches: DataFrame) -> DataFrame:
    """row, doc_id, kind, start, end, base and features of each match."""
    rows = matches.select("row", "doc_id", F.inline("hits"))
    along = Window.partitionBy("row", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("skipped") + F.length("s")).over(along)
    kinds = F.element_at(F.array(*[F.lit(KINDS.index(kind)) for kind, _, _ in GENERATORS]), F.col("generator") + 1)
    valid = F.lit(False)
    for k, kind in enumerate(KINDS):
        valid = F.when(F.col("kind") == k, _valid(kind, F.col("s"))).otherwise(valid)
    rows = rows.withColumn("end", end).withColumn("kind", kinds)
    return rows.select(
        "row",
        "doc_id",
        "kind",
        (F.col("end") - F.length("s")).alias("start"),
        "end",
        (F.col("generator") < len(BASE)).alias("base"),
        "generator",
        valid.cast("int").alias("valid"),
        F.least(F.length(_digits(F.col("s"))), F.lit(20)).alias("digits"),
        F.least(F.size(F.split("s", "[^A-Za-z0-9]+")), F.lit(9)).alias("groups"),
        F.col("before").rlike(CUES).cast("int").alias("cue"),
        F.col("before").rlike(r"[A-Za-z0-9_=/#]$").cast("int").alias("glued"),
        F.col("s").rlike("[A-Za-z]").cast("int").alias("letters"),
        F.col("s").rlike(r"\s").cast("int").alias("wide"),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """A row for each candidate of docs (doc_id, text)."""
    return _described(_matches(docs))


@dataclass
class Tree:
    """A stump of a stump: split, then each side's split or value."""

    feature: str | None = None
    cut: int = 0
    value: float = 0.0
    sides: list[Tree] = field(default_factory=list)

    def of(self, x: dict[str, int]) -> float:
        return self.value if self.feature is None else self.sides[x[self.feature] > self.cut].of(x)

    def column(self, c: Column) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(c[self.feature] > self.cut, self.sides[1].column(c)).otherwise(self.sides[0].column(c))


Row = tuple[dict[str, int], float, float]  # features, gradient sum, hessian sum


def _grow(rows: list[Row], depth: int, features: tuple[str, ...]) -> Tree:
    total_g, total_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = Tree(value=RATE * total_g / (total_h + 1.0))
    best, choice = total_g**2 / (total_h + 1.0) + 1e-6, None
    for f in features if depth else ():
        sums: dict[int, list[float]] = {}
        for x, g, h in rows:
            s = sums.setdefault(x[f], [0.0, 0.0])
            s[0] += g
            s[1] += h
        g = h = 0.0
        for cut in sorted(sums)[:-1]:
            g, h = g + sums[cut][0], h + sums[cut][1]
            gain = g**2 / (h + 1.0) + (total_g - g) ** 2 / (total_h - h + 1.0)
            if gain > best:
                best, choice = gain, (f, cut)
    if choice is None:
        return leaf
    f, cut = choice
    return Tree(f, cut, 0.0, [_grow([r for r in rows if r[0][f] <= cut], depth - 1, features), _grow([r for r in rows if r[0][f] > cut], depth - 1, features)])


@dataclass
class Model:
    bias: float
    trees: list[Tree]
    thresholds: dict[int, float]  # by kind; a kind without one is never added

    def logit(self, x: dict[str, int]) -> float:
        return self.bias + sum(t.of(x) for t in self.trees)

    def column(self, c: Column) -> Column:
        out = F.lit(self.bias)
        for t in self.trees:
            out = out + t.column(c)
        return out


def boost(counts: list[tuple[dict[str, int], int, float, float]], features: tuple[str, ...] = FEATURES) -> Model:
    """Trees from (features, kind, positives, negatives) of the training half, as (…, fold 0) rows; see ``train``."""
    positives, negatives = sum(r[2] for r in counts), sum(r[3] for r in counts)
    if not positives or not negatives:
        return Model(0.0, [], {})
    model = Model(math.log(positives / negatives), [], {})
    logits = [model.bias] * len(counts)
    for _ in range(ROUNDS):
        rows = []
        for (x, _, p, n), z in zip(counts, logits, strict=True):
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            rows.append((x, p * (1 - q) - n * q, (p + n) * q * (1 - q)))
        tree = _grow(rows, 2, features)
        model.trees.append(tree)
        logits = [z + tree.of(r[0]) for r, z in zip(counts, logits, strict=True)]
    return model


def calibrate(model: Model, counts: list[tuple[dict[str, int], int, float, float]], precision: float = PRECISION) -> None:
    """For each kind the lowest logit, not below even odds, above which held-out candidates are real with that precision."""
    for kind in range(len(KINDS)):
        scored = sorted(((model.logit(x), p, n) for x, k, p, n in counts if k == kind), key=lambda r: -r[0])
        right = wrong = 0.0
        threshold = None if scored else 0.0  # a kind never seen held out goes by the trees alone
        for i, (z, p, n) in enumerate(scored):
            right, wrong = right + p, wrong + n
            last = i + 1 == len(scored) or scored[i + 1][0] < z
            if z >= 0 and right >= precision * (right + wrong) and last:
                threshold = z if i + 1 < len(scored) and scored[i + 1][0] >= 0 else 0.0
        if threshold is not None:
            model.thresholds[kind] = threshold


#: (features, kind, positives, negatives) of which the trees are told besides.
PRIOR = [({"digits": d, "groups": g, "cue": c, "glued": b, "letters": a, "wide": w}, 0, 0.5 * (1 - b), 0.5 * b) for d in (9, 10, 12, 16) for g in (1, 2, 3, 4) for c in (0, 1) for b in (0, 1) for a in (0, 1) for w in (0, 1)]


def train(found: DataFrame) -> Model:
    """found: rows of ``candidates``.  Trees over LEARNT from the kinds of CHANCE.

    Of candidates that agree in kind and LEARNT, n fail the check; so n * q / (1 - q) of those that pass are lookalikes
    that passed by chance q, and the others that pass are real.
    """
    rows = found.where(F.col("kind").isin([KINDS.index(k) for k in CHANCE])).withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0)
    counts = rows.groupBy("held", *LEARNT, "kind").agg(F.sum("valid").alias("passed"), F.sum(1 - F.col("valid")).alias("failed")).collect()
    sides: dict[bool, list] = {False: list(PRIOR), True: []}
    for r in sorted(counts, key=str):
        q = CHANCE[KINDS[r["kind"]]]
        alike = r["failed"] * q / (1 - q)
        sides[r["held"]].append(({f: int(r[f]) for f in LEARNT}, int(r["kind"]), max(r["passed"] - alike, 0.0), alike))
    model = boost(sides[False], LEARNT)
    if model.trees:
        calibrate(model, sides[True])
    return model


def _name(c: Column) -> Column:
    return F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))


def _joined(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
    return F.array_join(F.transform(ordered, _name), ",")


def _chosen(spans: DataFrame) -> DataFrame:
    """row, kind, start, end, fixed of the fixed spans and of those that overlap none of them and no better one.

    spans: row, kind, generator, start, end, fixed.  Spans of one generator never overlap each other, so of each other
    generator only two can be better than a span that they overlap: the last that begins no later, and the first that
    ends no earlier.  The longer is better, of equal ones the earlier.
    """
    frame = (Window.unboundedPreceding, Window.currentRow)
    begun = Window.partitionBy("row").orderBy("start").rangeBetween(*frame)
    coming = Window.partitionBy("row").orderBy(F.col("start").desc()).rangeBetween(*frame)
    ending = Window.partitionBy("row").orderBy(F.col("end").desc()).rangeBetween(*frame)
    here = F.struct("start", "end")
    near, out = [], spans
    for g in range(len(BASE), len(GENERATORS)):
        one = F.when(~F.col("fixed") & (F.col("generator") == g), here)
        near += [(g, f"before{g}", F.last(one, ignorenulls=True).over(begun)), (g, f"after{g}", F.last(one, ignorenulls=True).over(ending))]
    out = out.select("*", *[c.alias(name) for _, name, c in near], F.max(F.when(F.col("fixed"), F.col("end"))).over(begun).alias("fixed_end"), F.min(F.when(F.col("fixed"), F.col("start"))).over(coming).alias("fixed_start"))
    free = ~F.coalesce(F.col("fixed_end") > F.col("start"), F.lit(False)) & ~F.coalesce(F.col("fixed_start") < F.col("end"), F.lit(False))
    for g, name, _ in near:
        b = F.col(name)
        longer = (b["end"] - b["start"]) - (F.col("end") - F.col("start"))
        first = (b["start"] < F.col("start")) | ((b["start"] == F.col("start")) & (F.lit(g) < F.col("generator")))
        beaten = (F.col("generator") != g) & (b["start"] < F.col("end")) & (F.col("start") < b["end"]) & ((longer > 0) | ((longer == 0) & first))
        free = free & ~F.coalesce(beaten, F.lit(False))
    return out.where(F.col("fixed") | free).select("row", "kind", "start", "end", "fixed")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added of every row of docs (doc_id, text)."""
    scratch = Scratch(docs.sparkSession, "pii")
    matches = scratch.write(_matches(docs))
    found = scratch.write(_described(matches.where(F.size("hits") > 0)))
    model = train(found)
    passes = F.lit(False)
    if model.thresholds:
        logit = model.column({f: F.col(f) for f in FEATURES})
        for kind, threshold in model.thresholds.items():
            passes = passes | ((F.col("kind") == kind) & (logit >= threshold))
    sound = found.where("valid = 1").select("row", "kind", "generator", "start", "end", F.col("base").alias("fixed"), passes.alias("passes")).where("fixed or passes")
    kept = _chosen(sound.drop("passes"))
    counts = [F.count(F.when(F.col("fixed") & (F.col("kind") == k), 1)).alias(f"n_{name}") for k, name in enumerate(BASE)]
    span = F.struct("start", "kind", "end")
    per = kept.groupBy("row").agg(*counts, F.collect_list(F.when(F.col("fixed"), span)).alias("base"), F.collect_list(span).alias("every"), F.count(F.when(~F.col("fixed"), 1)).alias("n_added"))
    per = per.select("row", *[f"n_{name}" for name in BASE], _joined(F.col("base")).alias("base"), _joined(F.col("every")).alias("spans"), "n_added")
    out = matches.select("row", "doc_id").join(per, "row", "left")
    whole = [F.coalesce(F.col(f"n_{name}"), F.lit(0)).cast("long").alias(f"n_{name}") for name in BASE]
    return out.select("doc_id", *whole, F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_added", F.lit(0)).cast("long").alias("n_added"))
