"""Secrets in texts: fixed forms, and strings that a battery of tests finds random.

Candidates are runs of 20 or more letters, digits and ``+/_-``, padding by ``=`` included,
that mix digits and letters. A ``=`` before more of them is no padding: it parts a name from
its value. Each is taken for one of a few encodings, or where none fits, for a string over a
joint alphabet of its letter case. Under the hypothesis of a random string
three statistics get a p-value: the chi-squared distance from equal shares of the alphabet,
the number of runs of digits, small letters, capitals and signs (ordinary strings have too
few), and the correlation of neighbours; Fisher's method combines them.

The p-values of random strings are even, those of ordinary ones lie near 0, and the nearer the
longer the string. So over the whole corpus, per encoding and length class, the p-values are
taken for a mixture of an even distribution and one of ordinary strings; its share is fitted.
It gives each string its probability of being ordinary, and strings are reported from the
largest p-value down while the mean of that probability among all reported, their expected
false share, is at most ``false_share``.

Only built-in functions are used. Null and empty texts have no spans; repeated rows are
separate rows and count as often in the corpus-wide fit; strings with equal p-values (of one
step) are reported together or not at all. A corpus without candidates, or an empty table, has
no limits and reports the fixed forms alone. Very long texts are searched whole. Input columns travel in a struct, so their
names are free.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableship.llm.common import packed, staged
from tableship.llm.spans import find_spans, free_of, let, redacted

# Fixed values of the contract: the three base kinds, in their order.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

#: Run starts only, so that a long run without digits is looked at once.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])"
    r"(?:[A-Za-z0-9+/_-]{20,}+(?:=++(?![A-Za-z0-9+/_-]))?"
    r"|(?=[A-Za-z0-9+/_=-]{20})[A-Za-z0-9+/_-]++=++(?![A-Za-z0-9+/_-]))"
)

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encodings in the order they are tried: name, characters, rule a string without its padding
#: must match. Every candidate fits one of the last three.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef", r"^[0-9a-f]+$"),
    ("HEX", _DIGITS + "ABCDEF", r"^[0-9A-F]+$"),
    ("base32", _UPPER + "234567", r"^[A-Z2-7]+$"),
    ("upper36", _DIGITS + _UPPER, r"^[0-9A-Z]+$"),
    ("lower36", _DIGITS + _LOWER, r"^[0-9a-z]+$"),
    ("base62", _DIGITS + _UPPER + _LOWER, r"^(?=.*[a-z])(?=.*[A-Z])[0-9A-Za-z]+$"),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$"),
    ("base64url", _UPPER + _LOWER + _DIGITS + "-_", r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$"),
    ("lower", _LOWER + _DIGITS + "+/-_", r"^[^A-Z]+$"),
    ("upper", _UPPER + _DIGITS + "+/-_", r"^[^a-z]+$"),
    ("joint", _UPPER + _LOWER + _DIGITS + "+/-_", r"^.+$"),
)

#: Kinds of characters: digits, small letters, capitals, signs.
_KINDS_OF = (_DIGITS, _LOWER, _UPPER, "+/-_")

#: Steps per power of ten and number of steps of the histogram of p-values.
_STEPS, _TOP = 20, 400

#: P-values of ordinary strings have density ``c * (1 - p) ** (c - 1)`` with these c and shares:
#: strings that are hard, less hard and easy to tell from random ones. Measured on slugs, paths
#: and identifiers of 20 to 60 characters; those of longer strings lie nearer to 0.
ORDINARY = ((12, 0.05), (45, 0.35), (2000, 0.6))

#: Random and ordinary strings assumed in each class beforehand.
_ASSUMED = (1.0, 0.5)

#: Rounds of the fit.
_ROUNDS = 60


@dataclass(frozen=True)
class Options:
    """``false_share``: expected share of ordinary strings among the random ones reported, at
    most; ``placeholder``: what stands for a secret in redacted texts."""

    false_share: float = 0.05
    placeholder: str = "[secret]"


DEFAULTS = Options()


def scan(docs: DataFrame, text: str = "text", options: Options = DEFAULTS) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``spans``, an array of (kind, start, end) in code
    points, ordered by start and kind."""
    found = _candidates(packed(docs), F.col("row").getField(text))
    return _with_spans(found, limits(found.select("random"), options)).select("row", "spans")


def scan_narrow(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", options: Options = DEFAULTS
) -> DataFrame:
    """``id`` and ``spans`` only; texts are read once, and what was found is written."""
    found = _candidates(packed(docs), F.col("row").getField(text))
    found = found.select(F.col("row").getField(id_column).alias("id"), "base", "random")
    found = staged(found, "secret-candidates")
    return _with_spans(found, limits(found.select("random"), options)).select("id", "spans")


def redact(docs: DataFrame, text: str = "text", options: Options = DEFAULTS) -> DataFrame:
    """``docs`` with the placeholder for each span; overlapping spans become one. Other
    columns, and null texts, stay as they are."""
    source = F.col("row").getField(text)
    kinds = {kind: _of_kind("spans", kind) for kind in KINDS}
    rest = let(lambda v: redacted(source, [v[k] for k in KINDS], options.placeholder), **kinds)
    clean = F.when(F.size("spans") > 0, rest).otherwise(source)
    columns = [
        clean.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns
    ]
    return scan(docs, text, options).select(*columns)


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def limits(found: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """One row: a map from encoding and length class to the last step of p-values whose strings
    are reported (-1: none).

    P-values are counted in steps of a twentieth of a power of ten, 11 encodings and at most
    32 length classes, so the table is bounded, and so is the fit of a class in one row.
    """
    strings = found.select(F.explode("random").alias("s")).select("s.group", "s.step")
    counts = strings.groupBy("group", "step").count()
    steps = counts.groupBy("group").agg(
        # At most _TOP + 1 rows per group.
        F.array_sort(
            F.collect_list(F.struct("step", "count", *_masses(F.col("step"))))
        ).alias("steps")
    )
    last = let(
        lambda v: _last_reported(v["steps"], v["share"], options.false_share),
        steps=F.col("steps"),
        share=_random_share(F.col("steps")),
    )
    return steps.select(F.struct("group", last.alias("last")).alias("entry")).agg(
        F.map_from_entries(F.collect_list("entry")).alias("limits")
    )


def _masses(step: Column) -> tuple[Column, Column]:
    """Share of the random and of the ordinary strings that have a p-value of this step."""
    high = F.pow(F.lit(10.0), -step / F.lit(float(_STEPS)))
    low = F.when(step >= _TOP, 0.0).otherwise(
        F.pow(F.lit(10.0), -(step + 1) / F.lit(float(_STEPS)))
    )

    def upto(p: Column) -> Column:
        rest = F.log1p(-F.least(p, F.lit(1 - 1e-12)))
        first, *others = (-share * F.expm1(c * rest) for c, share in ORDINARY)
        return sum(others, first)

    return (high - low).alias("random"), (upto(high) - upto(low)).alias("ordinary")


def _random(x: Column, share: Column) -> Column:
    """Probability that a string of step ``x`` is random."""
    return share * x["random"] / (share * x["random"] + (1 - share) * x["ordinary"])


def _random_share(steps: Column) -> Column:
    """Share of the random strings, by expectation and maximisation."""
    random, ordinary = _ASSUMED
    strings = F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x["count"])

    def better(share: Column, _: Column) -> Column:
        found = F.aggregate(
            steps, F.lit(random), lambda total, x: total + x["count"] * _random(x, share)
        )
        return found / (strings + random + ordinary)

    first = F.lit(random / (random + ordinary))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), first, better)


def _last_reported(steps: Column, share: Column, false_share: float) -> Column:
    """The largest step up to which the expected share of ordinary strings is small enough."""

    def add(state: Column, x: Column) -> Column:
        return let(
            lambda v: F.struct(
                v["ordinary"].alias("ordinary"),
                v["all"].alias("all"),
                F.when(v["ordinary"] <= false_share * v["all"], x["step"])
                .otherwise(state["last"])
                .alias("last"),
            ),
            ordinary=state["ordinary"] + x["count"] * (1 - _random(x, share)),
            all=state["all"] + x["count"],
        )

    start = F.struct(
        F.lit(0.0).alias("ordinary"), F.lit(0).cast("long").alias("all"), F.lit(-1).alias("last")
    )
    return F.aggregate(steps, start, add, lambda state: state["last"])


def _with_spans(found: DataFrame, last: DataFrame) -> DataFrame:
    def reported(s: Column) -> Column:
        return s["step"] <= F.coalesce(F.col("limits")[s["group"]], F.lit(-1))

    kept = F.filter("random", reported)
    # One row of at most a few hundred entries.
    joined = found.join(F.broadcast(last))
    spans = F.concat("base", F.transform(kept, lambda s: _span(F.lit(3), s)))
    ordered = F.array_sort(spans)
    named = F.transform(
        ordered,
        lambda s: F.struct(
            F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
        ),
    )
    return joined.withColumn("spans", named)


def _candidates(rows: DataFrame, text: Column) -> DataFrame:
    """``row``, the base spans and the strings to be tested that lie in none of them."""
    source = F.coalesce(text, F.lit(""))

    def judged(v: Column) -> Column:
        base = F.concat(
            F.transform(v["assign"], lambda s: _span(F.lit(0), s)),
            F.transform(v["access"], lambda s: _span(F.lit(1), s)),
            F.transform(v["hex"], lambda s: _span(F.lit(2), s)),
        )
        free = free_of(v["strings"], [v["assign"], v["access"], v["hex"]])
        return F.struct(base.alias("base"), F.transform(free, _tested).alias("random"))

    def secret(s: Column) -> Column:
        return F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= 8

    found = let(
        judged,
        assign=F.filter(find_spans(source, ASSIGN), secret),
        access=find_spans(source, ACCESS),
        hex=find_spans(source, HEX),
        strings=find_spans(source, CANDIDATE),
    )
    return rows.select("row", found.alias("found")).select("row", "found.base", "found.random")


def _span(kind: Column, s: Column) -> Column:
    return F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"))


def _tested(s: Column) -> Column:
    """(start, end, group, step) of a string."""
    body = F.regexp_replace(s["match"], "=+$", "")
    name = F.lit(ENCODINGS[-1][0])
    for label, _, rule in reversed(ENCODINGS[:-1]):
        name = F.when(body.rlike(rule), F.lit(label)).otherwise(name)
    known = F.create_map(
        *(x for name, alphabet, _ in ENCODINGS for x in (F.lit(name), _known(alphabet)))
    )

    def result(x: Column) -> Column:
        group = F.concat_ws("/", x["name"], F.floor(F.log2(F.length(x["body"]))).cast("string"))
        p = _p_value(x["body"], x["known"])
        step = F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * _STEPS)
        return F.struct(
            x["start"].alias("start"),
            x["end"].alias("end"),
            group.alias("group"),
            F.least(step, F.lit(_TOP)).cast("int").alias("step"),
        )

    return let(
        lambda x: let(
            result,
            start=x["start"],
            end=x["end"],
            name=x["name"],
            body=x["body"],
            known=known[x["name"]],
        ),
        start=s["start"],
        end=s["end"],
        name=name,
        body=body,
    )


def _known(alphabet: str) -> Column:
    """An alphabet, and the probabilities that the kind of character changes from one place to
    the next (``once``) and to the one after it as well (``twice``) in a random string."""
    shares = [sum(c in kind for c in alphabet) / len(alphabet) for kind in _KINDS_OF]
    squares, cubes = sum(q**2 for q in shares), sum(q**3 for q in shares)
    return F.struct(
        F.lit(alphabet).alias("alphabet"),
        F.lit(1 - squares).alias("once"),
        F.lit(1 - 2 * squares + cubes).alias("twice"),
    )


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda total, x: total + x)


def _neighbours(items: Column, n: Column, combine) -> Column:
    return F.zip_with(F.slice(items, 1, n - 1), F.slice(items, 2, n - 1), combine)


def _p_value(body: Column, known: Column) -> Column:
    """Fisher's combination of the three tests for a random string over an alphabet."""
    alphabet = known["alphabet"]
    # Each step names what the next one uses more than once.
    places = F.transform(F.split(body, ""), lambda c: F.instr(alphabet, c).cast("double"))
    letters = F.transform(
        F.split(alphabet, ""),
        lambda c: F.pow(F.length(body) - F.length(F.replace(body, c, F.lit(""))), F.lit(2.0)),
    )
    kinds = F.translate(
        body, "".join(_KINDS_OF), "".join(len(kind) * str(k) for k, kind in enumerate(_KINDS_OF))
    )
    runs = F.length(F.regexp_replace(kinds, r"(.)\1*+", "x"))

    def second(x: Column) -> Column:
        mean = _total(x["places"]) / x["n"]
        return let(
            third,
            n=x["n"],
            squares=_total(letters),
            changes=(runs - 1).cast("double"),
            mean=mean,
            places=x["places"],
        )

    def third(x: Column) -> Column:
        return let(
            fourth,
            n=x["n"],
            squares=x["squares"],
            changes=x["changes"],
            around=F.transform(x["places"], lambda v: v - x["mean"]),
        )

    def fourth(x: Column) -> Column:
        products = _neighbours(x["around"], x["n"].cast("int"), lambda a, b: a * b)
        return let(
            tests,
            n=x["n"],
            squares=x["squares"],
            changes=x["changes"],
            k=F.length(alphabet).cast("double"),
            products=_total(products),
            power=_total(F.transform(x["around"], lambda v: v * v)),
        )

    def tests(x: Column) -> Column:
        n, df, once = x["n"], x["k"] - 1, known["once"]
        spread = 2.0 / (9.0 * df)  # Wilson-Hilferty
        shares = F.cbrt((x["squares"] * x["k"] / n - n) / df)
        variance = (n - 1) * once * (1 - once) + 2 * (n - 2) * (known["twice"] - once * once)
        missing = ((n - 1) * once - x["changes"]) / F.sqrt(variance)
        serial = F.abs(x["products"] / x["power"] + 1 / n) * F.sqrt(n)
        logs = [
            F.log(F.greatest(p, F.lit(1e-100)))
            for p in (
                _upper_tail((shares - 1 + spread) / F.sqrt(spread)),
                _upper_tail(missing),
                F.when(x["power"] > 0, F.least(F.lit(1.0), 2 * _upper_tail(serial))).otherwise(0.0),
            )
        ]
        return let(fisher, half=-(logs[0] + logs[1] + logs[2]))

    def fisher(x: Column) -> Column:  # chi-squared with 6 degrees
        return F.exp(-x["half"]) * (1 + x["half"] + x["half"] * x["half"] / 2)

    return let(second, places=places, n=F.length(body).cast("double"))


def _upper_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, to about 1e-4 near the middle."""
    z = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070565992 * z * z * z))
