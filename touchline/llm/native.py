"""Places of regular expressions in texts, with built-in functions alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Match:
    """Columns about one match: places in code points, end exclusive, and what stands around it."""

    start: Column
    end: Column
    text: Column
    before: Column
    after: Column
    group: Column


def places(text: Column, pattern: str, build: Callable[[Match], Column], group: int = 0) -> Column:
    """An array with ``build`` of each leftmost non-overlapping match.

    Spark returns the matches and the pieces between them; adding up their lengths gives
    the places. ``group`` picks the part that ``Match.group`` shows.
    """
    regex = F.lit(pattern)
    looked_at = F.struct(
        F.regexp_extract_all(text, regex, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, regex, F.lit(group)).alias("group"),
        F.split(text, pattern, -1).alias("parts"),
    )
    nothing = Match(F.lit(0), F.lit(0), *[F.lit("")] * 4)
    none = F.slice(F.array(build(nothing)), 1, 0)

    def one(x: Column) -> Column:
        def step(t: Column, i: Column) -> Column:
            start = t["at"] + F.length(x["parts"][i])
            end = start + F.length(x["found"][i])
            match = Match(start, end, x["found"][i], x["parts"][i], x["parts"][i + 1], x["group"][i])
            return F.struct(end.alias("at"), F.array_append(t["out"], build(match)).alias("out"))

        # Appending copies an array, so matches are gathered in blocks of about the root of their number.
        n = F.size(x["found"])
        width = F.ceil(F.sqrt(n)).cast("int")

        def block(t: Column, first: Column) -> Column:
            last = F.least(first + width, n) - 1
            inner = F.aggregate(F.sequence(first, last), F.struct(t["at"].alias("at"), none.alias("out")), step)
            return bound(
                inner, lambda y: F.struct(y["at"].alias("at"), F.array_append(t["out"], y["out"]).alias("out"))
            )

        blocks = F.struct(F.lit(0).alias("at"), F.slice(F.array(none), 1, 0).alias("out"))
        return F.when(
            n > 0,
            F.aggregate(F.sequence(F.lit(0), n - 1, width), blocks, block, lambda t: F.flatten(t["out"])),
        ).otherwise(none)

    return bound(looked_at, one)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs in the result."""
    return F.element_at(F.transform(F.array(value), use), 1)
