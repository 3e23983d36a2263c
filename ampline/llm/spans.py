"""Spans of pattern matches in whole texts, as SQL expressions.

A text is cut at the matches, and the matches are taken as well; the running length of both gives the places. Spans are
structs of start, kind (a place in a list of names), end, hit and near (the text around, in lower case), in code points,
end exclusive. Texts without a match cost one search. Patterns must not match the empty text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = 512  # matches placed together
SPAN = "array<struct<start:int,kind:int,end:int,hit:string,near:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def spans(
    text: Column, pattern: str, kind: int, valid: Callable[[Column], Column] | None = None, width: int = 0,
    grow: Callable[[Column, Column], Column] | None = None, reach: int = 0,
) -> Column:
    """Leftmost non-overlapping matches of a Java pattern that pass ``valid``; failing ones are dropped.

    ``near`` has up to ``width`` characters before and after the span, whatever they belong to. With ``grow``, matches are
    heads of spans: of a head and the ``reach`` characters after it, ``grow`` tells how many of those belong to the span, or
    null to drop it. Heads inside a span that stays are none. With a width or ``grow``, patterns have no groups.
    """
    looks = width or grow

    def stepped(gaps: Column, hits: Column, behind: Column) -> Column:
        def step(side: Column, behind: Column) -> Column:
            return F.struct(
                F.char_length(side["gap"]).alias("gap"), side["hit"].alias("hit"), F.right(side["gap"], F.lit(width)).alias("before"),
                behind.alias("behind"), (grow(side["hit"], behind) if grow else F.lit(0)).alias("more"),
            )

        sides = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
        return F.zip_with(sides, behind, step) if looks else F.transform(sides, lambda side: step(side, F.lit("")))

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        head_end = start + F.char_length(step["hit"])
        end = head_end + F.coalesce(step["more"], F.lit(0))
        hit = F.concat(step["hit"], F.left(step["behind"], step["more"])) if grow else step["hit"]
        before, near = F.lit(""), F.lit("")
        if width:
            before = F.right(F.concat(done["before"], step["before"]), F.lit(width))
            after = F.substring(step["behind"], step["more"] + 1, F.lit(width))
            near, before = F.lower(F.concat_ws(" ", before, after)), F.right(F.concat(before, step["hit"]), F.lit(width))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), hit.alias("hit"), near.alias("near"))
        good = F.lit(True)
        if valid:
            good = good & valid(step["hit"])
        if grow:
            good = good & step["more"].isNotNull() & (start >= done["free"])
        return F.struct(
            head_end.alias("at"), before.alias("before"), (F.when(good, end).otherwise(done["free"]) if grow else F.lit(0)).alias("free"),
            (F.when(good, F.concat(done["found"], F.array(span))).otherwise(done["found"]) if valid or grow else F.concat(done["found"], F.array(span)))
            .cast(SPAN).alias("found"),
        )

    def add_part(done: Column, part: Column) -> Column:
        begin = F.struct(done["at"].alias("at"), done["before"].alias("before"), done["free"].alias("free"), no_spans().alias("found"))
        return F.aggregate(part, begin, add, lambda d: F.struct(
            d["at"], d["before"], d["free"], F.concat(done["found"], F.array(d["found"])).cast(f"array<{SPAN}>").alias("found")
        ))

    def in_parts(steps: Column) -> Column:
        """Arrays grow by copying, so many matches are placed in parts."""
        cuts = F.sequence(F.lit(0), F.size(steps) - 1, F.lit(PART))
        parts = F.transform(cuts, lambda cut: F.slice(steps, cut + 1, F.lit(PART)))
        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), F.lit(0).alias("free"), F.array().cast(f"array<{SPAN}>").alias("found"))
        return F.flatten(F.aggregate(parts, begin, add_part, lambda done: done["found"]))

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        """A variable of a function over a list of one holds the value, which is then computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    behind = F.regexp_extract_all(text, F.lit(f"(?:{pattern})(?=((?s:.{{0,{reach + width}}})))"), F.lit(1)) if looks else no_spans()
    placed = once(F.split(text, pattern, -1), lambda gaps: once(hits, lambda found: once(stepped(gaps, found, behind), in_parts)))
    return F.when(text.rlike(pattern), placed).otherwise(no_spans())


def merged(*lists: Column) -> Column:
    """All spans by start, then kind."""
    return F.array_sort(F.concat(*lists))


def spelled(found: Column, names: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, joined by commas."""
    kinds = F.array(*[F.lit(n) for n in names])
    parts = F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(parts, ",")


def count_of(found: Column, kind: int) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")
