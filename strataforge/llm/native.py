"""Column helpers for operators that run on built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that one step of a running total handles: keeps its cost linear in the length.
_BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value worked out once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(values: Column) -> Column:
    """Inclusive running sums of an array of numbers, as longs; empty for an empty array."""

    def scan(block: Column) -> Column:
        return F.aggregate(block, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def blocks(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")), lambda b: scan(F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK))))

    def join(parts: Column) -> Column:
        starts = scan(F.transform(parts, lambda p: F.element_at(p, -1)))
        return F.flatten(F.zip_with(parts, F.slice(starts, F.lit(1), F.size(parts)), lambda p, s: F.transform(F.slice(p, F.lit(2), F.size(p) - 1), lambda x: x + s)))

    return let(values, lambda a: F.when(F.size(a) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks(a), join)))


def spans(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points, end exclusive.

    The stretches between matches come from split, the matches from regexp_extract_all; their lengths, taken in turn,
    add up to the places. The pattern must not match the empty string.
    """
    pairs = lambda gaps, hits: F.flatten(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.array(F.length(g).cast("long"), F.length(h).cast("long"))))
    placed = lambda hits: let(
        running_totals(pairs(F.split(text, pattern), hits)),
        lambda at: F.transform(hits, lambda h, i: F.struct(F.get(at, 2 * i).alias("start"), F.get(at, 2 * i + 1).alias("end"), h.alias("value"))),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.when(F.size(hits) == 0, none).otherwise(placed(hits)))


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))
