"""Personal data in texts: fixed forms, and candidates that boosted trees accept.

Generators propose spans with high recall, and these may overlap: addresses also with ``at`` and
``dot`` in brackets, digit groups of any layout, account codes and long colon-separated codes.
Each candidate gets a few small-number features of its format and its context, so candidates
fall into cells, at most ``CELLS`` of them whatever the size of the corpus. One aggregation
counts, for each cell, how many candidates are borne out (they are one of the fixed forms, with
its checks, or an account code whose check digits are right) and how many are not. The counts
of all cells train gradient-boosted trees on the driver; no candidate is sampled or left out.
The checks themselves are no features: the trees learn what borne-out candidates look like and
what stands around them, and find others of that look.

A quarter of the candidates, by a hash of their text, is kept out of training. On it each kind gets
its threshold: the lowest score from which on the share of borne-out ones, with one false one
added, is at least ``precision``. A kind without such a score accepts none. Candidates that are
not borne out count as false there although some are not, so the share is a lower bound.

The trees become column expressions; only built-in functions touch texts and candidates. Of
accepted candidates that overlap one another the better score stays, of equal ones the first; what overlaps a
fixed form is dropped, as the fixed forms always stay. Account codes with right check digits
are accepted whatever their score.

Null and empty texts have no spans; repeated rows are separate rows and count as often; a table
without rows or candidates trains no trees and reports nothing. A long text is searched whole,
and its spans are found without growth by the square of their number (see ``spans``). Columns
travel in a struct, so their names are free.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableship.llm.common import packed, staged
from tableship.llm.spans import find_context, find_spans, is_free, let, redacted

# Fixed values of the contract: the four base kinds, in their order. Runs are entered at their
# start or where the match before has ended, and are not given back, which changes no match.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ("email", "ip", "card", "phone")

#: Kinds of candidates and what proposes them.
GENERATORS = {
    "address": (
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|[(\[{]\x20?at\x20?[)\]}])\x20?"
        r"[A-Za-z0-9-]{1,63}+(?:\x20?(?:\.|[(\[{]\x20?dot\x20?[)\]}])\x20?[A-Za-z0-9-]{1,63}+)*+"
    ),
    "number": r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20()./-]{0,3}[0-9]){5,}+",
    "account": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}+(?![0-9A-Za-z])",
    "code": r"(?<![0-9A-Za-z:.-])(?:[0-9A-Fa-f]{1,4}[:-]){3,7}+[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:.-])",
}
KINDS = (*BASE, *GENERATORS)

#: Words before a candidate that speak for personal data, one feature value for each line.
CUES = (
    r"\b(?:phone|tel|call|fax|mobile|cell|telefon|tél|teléfono|handy)\b",
    r"\b(?:mail|e-mail|contact|write|kontakt|contacto|courriel|correo)\b",
    r"\b(?:ssn|social security|passport|id|license|personalausweis|dni|nif|birth|born)\b",
    r"\b(?:card|visa|iban|account|konto|cuenta|compte|bank)\b",
    r"\b(?:ip|host|server|address|adresse|dirección)\b",
    r"(?:\b(?:version|build|isbn|page|figure|eq|no|nr|total|sum)\b\.?|[$€£#=])",
)

#: Features of a candidate and how many values each has.
FEATURES = {
    "digits": 8,  # number of digits
    "letters": 4,  # number of letters
    "groups": 6,  # groups of digits
    "layout": 6,  # what parts the groups
    "lead": 4,  # plus, bracket, zero or other at the start
    "cue": len(CUES) + 1,
    "left": 4,  # character before
    "right": 4,  # character after
}
CELLS = len(GENERATORS) * math.prod(FEATURES.values())


@dataclass(frozen=True)
class Options:
    """Share of true ones a threshold must keep; rounds, depth and step of the boosting; least
    weight of a leaf; placeholder of redacted texts."""

    precision: float = 0.9
    rounds: int = 24
    depth: int = 3
    step: float = 0.3
    least: float = 5.0
    placeholder: str = "[personal data]"


DEFAULTS = Options()


# Candidates


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _passes_luhn(digits: Column) -> Column:
    def doubled(c: Column, i: Column) -> Column:
        d = F.instr(F.lit("0123456789"), c) - 1
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    each = F.transform(F.split(F.reverse(digits), ""), doubled)
    return F.aggregate(each, F.lit(0), lambda total, x: total + x) % 10 == 0


def _between(length: Column, low: int, high: int) -> Column:
    return (length >= low) & (length <= high)


def _is_card(s: Column) -> Column:
    digits = _digits(s["match"])
    # The sum is taken only of strings of the right length.
    return F.when(_between(F.length(digits), 12, 19), _passes_luhn(digits)).otherwise(F.lit(False))


def _is_ip(s: Column) -> Column:
    part = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    return s["match"].rlike(rf"\A{part}\.{part}\.{part}\.{part}\z")


def _is_phone(s: Column) -> Column:
    return _between(F.length(_digits(s["match"])), 9, 15)


def _has_check_digits(match: Column) -> Column:
    """Whether a code is an account number by its check digits: the rest of its digits, with
    letters as 10 to 35 and the first four characters last, divided by 97, is 1."""
    code = F.regexp_replace(match, "[^A-Z0-9]", "")
    turned = F.concat(F.substring(code, 5, 100), F.left(code, F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
        return (F.when(value < 10, rest * 10).otherwise(rest * 100) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _step(value: Column, bounds: list[int]) -> Column:
    """Number of bounds that a value reaches."""
    total = F.lit(0)
    for bound in bounds:
        total = total + (value >= bound).cast("int")
    return total


def _first_of(cases: list[Column], other: int) -> Column:
    found = F.lit(other)
    for k in range(len(cases) - 1, -1, -1):
        found = F.when(cases[k], k).otherwise(found)
    return found


def _edge(character: Column) -> Column:
    return _first_of(
        [character == "", character.rlike(r"\s"), character.rlike(r"[\p{L}\p{N}]")], 3
    )


def _features(s: Column) -> list[Column]:
    match, before = s["match"], F.lower(s["before"])
    digits = F.length(_digits(match))
    letters = F.length(F.regexp_replace(match, r"[^\p{L}]", ""))
    groups = F.size(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0)))
    values = {
        "digits": _step(digits, [6, 8, 9, 10, 12, 14, 17]),
        "letters": _step(letters, [1, 3, 8]),
        "groups": _step(groups, [1, 2, 3, 4, 5]),
        "layout": _first_of(
            [
                match.contains("@"),
                match.contains("("),
                match.contains("."),
                match.contains("-"),
                match.contains(" "),
            ],
            5,
        ),
        "lead": _first_of([match.startswith("+"), match.startswith("("), match.startswith("0")], 3),
        "cue": _first_of([before.rlike(cue) for cue in CUES], len(CUES)),
        "left": _edge(F.right(s["before"], F.lit(1))),
        "right": _edge(F.left(s["after"], F.lit(1))),
    }
    return [values[name].alias(name) for name in FEATURES]


def _candidates(rows: DataFrame, text: Column) -> DataFrame:
    """``row``, the spans of each base kind, and ``candidates``: kind, place, features and whether
    they are borne out."""
    source = F.coalesce(text, F.lit(""))

    def all_of(v: Column) -> Column:
        base = [v[kind] for kind in BASE]

        def described(kind: str):
            number = list(GENERATORS).index(kind)

            def candidate(s: Column) -> Column:
                sound = _has_check_digits(s["match"]) if kind == "account" else F.lit(False)
                return F.struct(
                    F.lit(number).alias("kind"),
                    s["start"].alias("start"),
                    s["end"].alias("end"),
                    # Borne out by the base span it overlaps: it serves to learn from.
                    (~is_free(s, base)).alias("is_base"),
                    sound.alias("sound"),
                    (F.pmod(F.xxhash64(s["match"]), F.lit(4)) == 0).alias("kept_out"),
                    *_features(s),
                )

            return F.transform(v[kind], candidate)

        return F.struct(
            *(v[kind].alias(kind) for kind in BASE),
            F.concat(*map(described, GENERATORS)).alias("candidates"),
        )

    found = let(
        all_of,
        email=find_spans(source, EMAIL),
        ip=F.filter(find_spans(source, IP), _is_ip),
        card=F.filter(find_spans(source, CARD), _is_card),
        phone=F.filter(find_spans(source, PHONE), _is_phone),
        **{kind: find_context(source, regex, 24, 4) for kind, regex in GENERATORS.items()},
    )
    found = rows.select("row", found.alias("found"))
    return found.select("row", *(f"found.{name}" for name in (*BASE, "candidates")))


# Boosting


@dataclass(frozen=True)
class Tree:
    """Feature and value of the split and what lies at or below it and above it; or a leaf."""

    value: float = 0.0
    feature: str | None = None
    bound: int = 0
    low: Tree | None = None
    high: Tree | None = None


@dataclass(frozen=True)
class Model:
    """Trees per kind of candidate, the log odds they start from, and the score to reach."""

    trees: dict[str, list[Tree]]
    start: dict[str, float]
    threshold: dict[str, float]


def cells(found: DataFrame) -> DataFrame:
    """Counts per kind and feature values: ``true``, ``false`` and, of candidates kept out of
    training, ``true_out``, ``false_out``. At most ``CELLS`` rows."""
    each = found.select(F.explode("candidates").alias("c")).select("c.*")
    true = F.col("is_base") | F.col("sound")
    out = F.col("kept_out")
    return each.groupBy("kind", *FEATURES).agg(
        F.count_if(true & ~out).alias("true"),
        F.count_if(~true & ~out).alias("false"),
        F.count_if(true & out).alias("true_out"),
        F.count_if(~true & out).alias("false_out"),
    )


def fit(counted: DataFrame, options: Options = DEFAULTS) -> Model:
    """Boosted trees and thresholds from the counts of all cells."""
    rows = counted.orderBy("kind", *FEATURES).collect()
    trees, start, threshold = {}, {}, {}
    for number, kind in enumerate(GENERATORS):
        own = [r for r in rows if r["kind"] == number]
        x = np.array([[r[f] for f in FEATURES] for r in own], np.int64).reshape(len(own), len(FEATURES))
        n = np.array([[r["true"], r["false"], r["true_out"], r["false_out"]] for r in own], float)
        n = n.reshape(len(own), 4)
        if not len(own) or n[:, 0].sum() == 0:
            trees[kind], start[kind], threshold[kind] = [], 0.0, math.inf
            continue
        trees[kind], start[kind], score = _boost(x, n[:, 0], n[:, 1], options)
        threshold[kind] = _threshold(score, n[:, 2], n[:, 3], options.precision)
    return Model(trees, start, threshold)


def _boost(x: np.ndarray, true: np.ndarray, false: np.ndarray, options: Options):
    """Logistic boosting with Newton leaves over weighted cells."""
    weight = true + false
    start = math.log((true.sum() + 1) / (false.sum() + 1))
    score = np.full(len(x), start)
    trees = []
    for _ in range(options.rounds):
        p = 1 / (1 + np.exp(-score))
        slope, bend = true - weight * p, weight * p * (1 - p)
        tree = _grow(x, slope, bend, weight, np.ones(len(x), bool), options.depth, options)
        trees.append(tree)
        score = score + np.array([_value(tree, row) for row in x])
    return trees, start, score


def _grow(x, slope, bend, weight, here, depth, options: Options) -> Tree:
    def leaf(rows):
        return options.step * slope[rows].sum() / (bend[rows].sum() + 1.0)

    def gain(rows):
        return slope[rows].sum() ** 2 / (bend[rows].sum() + 1.0)

    best = (1e-6, None, 0)
    if depth:
        for k, (name, values) in enumerate(FEATURES.items()):
            for bound in range(values - 1):
                low, high = here & (x[:, k] <= bound), here & (x[:, k] > bound)
                if min(weight[low].sum(), weight[high].sum()) < options.least:
                    continue
                better = gain(low) + gain(high) - gain(here)
                if better > best[0]:
                    best = (better, name, bound)
    _, name, bound = best
    if name is None:
        return Tree(float(leaf(here)))
    at = x[:, list(FEATURES).index(name)] <= bound
    low = _grow(x, slope, bend, weight, here & at, depth - 1, options)
    high = _grow(x, slope, bend, weight, here & ~at, depth - 1, options)
    return Tree(0.0, name, bound, low, high)


def _value(tree: Tree, row: np.ndarray) -> float:
    while tree.feature:
        tree = tree.low if row[list(FEATURES).index(tree.feature)] <= tree.bound else tree.high
    return tree.value


def _threshold(score, true, false, precision: float) -> float:
    """Lowest score with enough true ones at or above it."""
    found = math.inf
    for s in sorted(set(np.round(score, 9)), reverse=True):
        at = np.round(score, 9) >= s
        kept, wrong = true[at].sum(), false[at].sum()
        if kept and kept / (kept + wrong + 1) >= precision:
            found = s
    return found


def _scored(model: Model, c: Column) -> Column:
    """Log odds of a candidate."""

    def column(tree: Tree) -> Column:
        if not tree.feature:
            return F.lit(tree.value)
        low = c[tree.feature] <= tree.bound
        return F.when(low, column(tree.low)).otherwise(column(tree.high))

    total = F.lit(0.0)
    for number, kind in enumerate(GENERATORS):
        score = F.lit(model.start[kind])
        for tree in model.trees[kind]:
            score = score + column(tree)
        total = F.when(c["kind"] == number, score).otherwise(total)
    return total


def _limit(model: Model, c: Column) -> Column:
    limit = F.lit(math.inf)
    for number, kind in enumerate(GENERATORS):
        own = F.lit(float(model.threshold[kind]))
        limit = F.when(c["kind"] == number, own).otherwise(limit)
    return limit


# Scans


def scan(docs: DataFrame, text: str = "text", options: Options = DEFAULTS) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``spans``, an array of (kind, start, end) in code
    points, ordered by start and kind. Texts are read twice, once to learn."""
    found = _candidates(packed(docs), F.col("row").getField(text))
    model = fit(cells(found.select("candidates")), options)
    return found.select("row", _spans(model).alias("spans"))


def scan_narrow(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """``id`` and ``spans`` only; texts are read once, and what was found is written."""
    found = _candidates(packed(docs), F.col("row").getField(text))
    found = found.withColumn("id", F.col("row").getField(id_column)).drop("row")
    places = [
        F.transform(kind, lambda s: F.struct(s["start"], s["end"])).alias(kind) for kind in BASE
    ]
    found = staged(found.select("id", *places, "candidates"), "pii-candidates")
    model = fit(cells(found.select("candidates")), options)
    return found.select("id", _spans(model).alias("spans"))


def redact(docs: DataFrame, text: str = "text", options: Options = DEFAULTS) -> DataFrame:
    """``docs`` with the placeholder for each span; overlapping spans become one. Other columns,
    and null texts, stay as they are."""
    source = F.col("row").getField(text)

    def of_kind(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    kinds = {kind: of_kind(kind) for kind in KINDS}
    clean = let(lambda v: redacted(source, [v[k] for k in KINDS], options.placeholder), **kinds)
    clean = F.when(F.size("spans") > 0, clean).otherwise(source)
    columns = [
        clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    return scan(docs, text, options).select(*columns)


def _spans(model: Model) -> Column:
    """Base spans and accepted candidates, by start and kind."""

    def span(number, s: Column) -> Column:
        return F.struct(s["start"].alias("start"), number.alias("kind"), s["end"].alias("end"))

    def judged(c: Column) -> Column:
        return F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            (c["kind"] + len(BASE)).alias("kind"),
            F.when(c["sound"], F.lit(math.inf)).otherwise(_scored(model, c)).alias("score"),
            _limit(model, c).alias("limit"),
        )

    def base_of(number: int, kind: str) -> Column:
        return F.transform(kind, lambda s: span(F.lit(number), s))

    base = F.concat(*(base_of(number, kind) for number, kind in enumerate(BASE)))
    scored = F.transform(F.filter("candidates", lambda c: ~c["is_base"]), judged)
    accepted = F.filter(scored, lambda c: (c["score"] >= c["limit"]) & (c["score"] != -math.inf))
    accepted = F.array_sort(accepted)

    def better(state: Column, c: Column) -> Column:
        # Sorted by start: only the last one kept can overlap the next.
        last = F.element_at(state, -1)
        return (
            F.when((F.size(state) == 0) | (F.get(state, F.size(state) - 1)["end"] <= c["start"]), F.concat(state, F.array(c)))
            .when(c["score"] > last["score"], F.concat(F.slice(state, 1, F.size(state) - 1), F.array(c)))
            .otherwise(state)
        )

    none = F.array().cast("array<struct<start:int,end:int,kind:int,score:double,limit:double>>")
    added = F.transform(F.aggregate(accepted, none, better), lambda c: span(c["kind"], c))
    names = F.array(*map(F.lit, KINDS))
    return F.transform(
        F.array_sort(F.concat(base, added)),
        lambda s: F.struct(
            F.element_at(names, s["kind"] + 1).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
        ),
    )
