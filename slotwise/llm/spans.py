"""Spans of pattern matches as native column expressions.

A span is a struct (s, k, e, t): start, the kind's place in its list, end
(exclusive, in code points) and the matched text. Sorting spans sorts by start,
then kind.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.llm.common import let

SPAN = "array<struct<s:bigint,k:int,e:bigint,t:string>>"
BLOCK = 256


def _prefix(values: Column) -> Column:
    """Struct (out, total) of the running sums of a short array."""
    zero = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("total"))
    add = lambda a, x: F.struct(F.concat(a["out"], F.array(a["total"] + x)).alias("out"), (a["total"] + x).alias("total"))
    return F.aggregate(values, zero, add)


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array of bigint.

    Growing an array copies it, so sums run inside blocks and over the blocks'
    totals: a text with a million matches costs thousands of copies, not
    a million.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
        lambda b: _prefix(F.slice(values, b * BLOCK + 1, BLOCK)),
    )
    joined = lambda bs: F.flatten(F.zip_with(
        bs, _prefix(F.transform(bs, lambda b: b["total"]))["out"], lambda b, up_to: F.transform(b["out"], lambda v: v + up_to - b["total"])
    ))
    return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks, joined))


def matches(text: Column, pattern: str, order: int, accept: Callable[[Column], Column] | None = None) -> Column:
    """Leftmost non-overlapping matches of a Java pattern that ``accept`` lets pass.

    Splitting at the pattern gives the text between the matches, so places
    follow from the running lengths. The pattern must not match nothing.
    """
    def placed(found: Column) -> Column:
        lengths = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found, lambda gap, x: (F.length(gap) + F.length(x)).cast("bigint"))
        ends = let(lengths, running_sums)
        return F.zip_with(found, ends, lambda x, e: F.struct((e - F.length(x)).alias("s"), F.lit(order).alias("k"), e.alias("e"), x.alias("t")))

    all_found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, none()).otherwise(placed(m)))
    return all_found if accept is None else F.filter(all_found, lambda x: accept(x["t"]))


def none() -> Column:
    return F.array().cast(SPAN)


def guarded(guard: Column, spans: Column) -> Column:
    """``spans`` where the cheap necessary condition ``guard`` holds, else none."""
    return F.when(guard, spans).otherwise(none())


def listed(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    one = lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def n_of(spans: Column, order: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == order)).cast("bigint")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda b: (b["s"] < span["e"]) & (span["s"] < b["e"]))


def masked(text: Column, spans: Column, kinds: Sequence[str]) -> Column:
    """``text`` with each span, or run of overlapping ones, replaced by ``[KIND]``."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in kinds))

    def step(a: Column, x: Column) -> Column:
        inside = x["s"] < a["at"]
        gap = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(x["s"] - a["at"], F.lit(0)).cast("int"))
        parts = F.when(inside, a["parts"]).otherwise(F.concat(a["parts"], F.array(gap, F.get(names, x["k"]))))
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(F.array_sort(spans), start, step, rest))
