"""Places of regular expressions in texts, with built-in functions only.

Arrays of spans may be long: one text can hold thousands of matches. So running sums are taken
block by block, overlaps are found by bisection, and the pieces of a text are cut from blocks of
it; none of these grows with the square of the number of spans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<start:int,end:int,match:string>>"
CONTEXT_TYPE = "array<struct<start:int,end:int,match:string,before:string,after:string>>"

#: Entries of a block of running sums; code points of a block of text.
_ENTRIES, _POINTS = 256, 1024


def no_spans() -> Column:
    return F.array().cast(SPAN_TYPE)


def let(use, **values: Column) -> Column:
    """``use`` of a struct of the values, each of which is computed once. Inside a lambda
    function a column would be computed again for every element."""
    row = F.struct(*(value.alias(name) for name, value in values.items()))
    return F.transform(F.array(row), use)[0]


def find_spans(text: Column, regex: str) -> Column:
    """Leftmost matches that do not overlap, as (start, end, match) in code points.

    The pieces between the matches and the matches themselves alternate, so that running
    sums of their lengths are the places. Texts without a match cost one search.
    """

    def found(v: Column) -> Column:
        return F.zip_with(
            v["starts"],
            v["matches"],
            lambda start, match: F.struct(
                start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match")
            ),
        )

    return F.when(text.rlike(regex), _matched(text, regex, found)).otherwise(no_spans())


def find_context(text: Column, regex: str, before: int, after: int) -> Column:
    """``find_spans`` with the code points ``before`` each match, back to the match before at the
    most, and ``after`` it."""

    def found(v: Column) -> Column:
        return F.transform(
            v["matches"],
            lambda match, i: F.struct(
                v["starts"][i].alias("start"),
                (v["starts"][i] + F.length(match)).alias("end"),
                match.alias("match"),
                F.right(v["gaps"][i], F.lit(before)).alias("before"),
                F.left(v["gaps"][i + 1], F.lit(after)).alias("after"),
            ),
        )

    none = F.array().cast(CONTEXT_TYPE)
    return F.when(text.rlike(regex), _matched(text, regex, found)).otherwise(none)


def _matched(text: Column, regex: str, use) -> Column:
    """``use`` of a struct of ``gaps``, ``matches`` and ``starts`` of a text that has matches."""

    def placed(v: Column) -> Column:
        # A gap and its match make a step; a match starts where its gap ends.
        steps = F.zip_with(
            F.slice(v["gaps"], 1, F.size(v["matches"])),
            v["matches"],
            lambda gap, match: F.struct(
                F.length(gap).alias("gap"), (F.length(gap) + F.length(match)).alias("step")
            ),
        )
        return let(
            lambda w: use_of(v, w["steps"]),
            steps=steps,
        )

    def use_of(v: Column, steps: Column) -> Column:
        return let(use, gaps=v["gaps"], matches=v["matches"], starts=_starts(steps))

    return let(
        placed,
        gaps=F.split(text, regex, -1),
        matches=F.regexp_extract_all(text, F.lit(regex), F.lit(0)),
    )


def _starts(steps: Column) -> Column:
    """Running sums of ``step`` before each entry, plus its ``gap``."""
    blocks = F.transform(
        F.sequence(F.lit(1), F.size(steps), F.lit(_ENTRIES)),
        lambda first: F.slice(steps, first, F.least(F.lit(_ENTRIES), F.size(steps) - first + 1)),
    )

    def totals(v: Column) -> Column:
        sums = F.transform(
            v["blocks"], lambda b: F.aggregate(b, F.lit(0), lambda total, x: total + x["step"])
        )
        return let(
            lambda w: within(v, w["offsets"]),
            offsets=_summed(sums, lambda x: x, F.lit(0), lambda at, x: at),
        )

    def within(v: Column, offsets: Column) -> Column:
        return F.flatten(
            F.zip_with(
                v["blocks"],
                offsets,
                lambda b, offset: _summed(b, lambda x: x["step"], offset, lambda at, x: at + x["gap"]),
            )
        )

    return let(totals, blocks=blocks)


def _summed(items: Column, step, first: Column, place) -> Column:
    state = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(
        items,
        state,
        lambda s, x: F.struct(
            (s["at"] + step(x)).alias("at"),
            F.concat(s["out"], F.array(place(s["at"], x))).alias("out"),
        ),
        lambda s: s["out"],
    )


def _first_ending_after(spans: Column, at: Column) -> Column:
    """The first of spans, sorted and apart, that ends after ``at``; null if none does."""
    low = F.aggregate(
        F.sequence(F.lit(1), F.lit(31)),
        F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")),
        lambda s, _: let(
            lambda v: F.when(v["low"] >= v["high"], F.struct(v["low"], v["high"]))
            .when(spans[v["mid"]]["end"] > at, F.struct(v["low"], v["mid"].alias("high")))
            .otherwise(F.struct((v["mid"] + 1).alias("low"), v["high"])),
            low=s["low"],
            high=s["high"],
            mid=F.floor((s["low"] + s["high"]) / 2).cast("int"),
        ),
        lambda s: s["low"],
    )
    return F.get(spans, low)


def is_free(span: Column, groups: list[Column]) -> Column:
    """Whether a span overlaps none in any of the groups, each of which is sorted and has no
    overlaps within."""
    free = F.lit(True)
    for group in groups:
        nearest = _first_ending_after(group, span["start"])
        free = free & F.coalesce(nearest["start"] >= span["end"], F.lit(True))
    return free


def free_of(spans: Column, groups: list[Column]) -> Column:
    """Spans that overlap none in any of the groups."""
    return F.filter(spans, lambda s: is_free(s, groups))


def redacted(text: Column, groups: list[Column], placeholder: str) -> Column:
    """``text`` with the placeholder for each span of the groups (see ``is_free``), all of them
    values of a ``let``; overlapping spans become one."""

    def outside(group: Column):
        return lambda p: F.coalesce(_first_ending_after(group, p)["start"] >= p, F.lit(True))

    def edges(name: str) -> Column:
        # Of the union: starts and ends that lie inside of no span.
        points = F.flatten(F.array(*(F.transform(g, lambda s: s[name]) for g in groups)))
        for group in groups:
            points = F.filter(points, outside(group))
        return F.array_sort(F.array_distinct(points))

    def cut(v: Column) -> Column:
        def piece(start: Column, stop: Column) -> Column:
            first, last = F.floor(start / _POINTS), F.floor((stop - 1) / _POINTS)
            near = F.slice(v["blocks"], (first + 1).cast("int"), (last - first + 1).cast("int"))
            return F.when(stop <= start, F.lit("")).otherwise(
                F.substr(
                    F.array_join(near, ""), (start % _POINTS + 1).cast("int"), (stop - start).cast("int")
                )
            )

        pieces = F.zip_with(
            F.concat(F.array(F.lit(0)), v["ends"]),
            F.concat(v["starts"], F.array(F.length(text))),
            piece,
        )
        return F.array_join(pieces, placeholder)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_POINTS}}}"), F.lit(0))
    return let(cut, blocks=blocks, starts=edges("start"), ends=edges("end"))
