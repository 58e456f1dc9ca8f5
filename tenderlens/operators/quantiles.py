"""Exact quantiles without gathering a group in one task.

``percentile`` and ``median`` keep a map of every distinct value of a group in one buffer, which
fails for a large group.  So ranks are found digit by digit, at every size of the table.
``order_code`` turns a number into a 64-bit integer of the same order, read as four digits
of 16 bits:

1. count rows per group and first digit;
2. running totals over those counts tell which digit holds each wanted rank;
3. count the distinct values with the wanted first digits only;
4. three times, count the next digit of the values whose digits so far are wanted.

The table is scanned twice.  All steps aggregate map-side before they shuffle, and no running
total has more than 65,536 rows, so neither a large group nor a frequent value nor a narrow range of
very many values loads one task.  The result is the exact linearly interpolated quantile.

``quantile_answers`` answers many requests, each with its own column and groups, in the same two scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Targets of at most this many groups are broadcast to the second scan.
MAX_BROADCAST_GROUPS = 20_000

_DIGIT_BITS, _DIGITS = 16, 4
# Of a double: bits of the fraction, the smallest exponent, and the offset that makes exponents positive.
_FRACTION_BITS, _LEAST_EXPONENT, _EXPONENT_BIAS = 52, -1022, 1023

_GROUP, _VALUE, _COUNT, _CODE, _WANTED = "_g", "_v", "_n", "_c", "_w"


@dataclass(frozen=True)
class Request:
    """Quantiles of one column: ``points`` maps output columns to probabilities.

    ``keys`` name columns of the table; ``groups_bounded`` states that they have few values by construction,
    which saves the check before the ranks are broadcast.
    """

    value: Column
    points: Mapping[str, float]
    keys: Sequence[str] = field(default=())
    groups_bounded: bool = False


def few_groups(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether ``df`` has few enough groups to broadcast one small row per group and rank.

    Runs one aggregation over the key columns alone.
    """
    key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    groups = df.agg(F.approx_count_distinct(key).alias("groups")).first()[0]
    return groups <= MAX_BROADCAST_GROUPS


def is_present(value: Column) -> Column:
    """Neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def with_order_code(df: DataFrame, value: str, code: str) -> DataFrame:
    """``df`` with a bigint that orders like the double ``value``; equal doubles have equal codes.

    The code holds exponent and fraction as the double itself does: powers of two and quotients by
    them are exact, so it is exact too, subnormal numbers and infinities included.  It is never NULL.
    """
    size = F.abs(F.col(value))
    near = F.least(F.greatest(F.floor(F.log2(size)), F.lit(_LEAST_EXPONENT)), F.lit(_EXPONENT_BIAS))
    # The logarithm is rounded, so it may be off by one at a power of two.  Zero has none.
    found = df.select("*", F.coalesce(near, F.lit(_LEAST_EXPONENT)).cast("int").alias("_near"))
    power = F.pow(F.lit(2.0), F.col("_near"))
    over = F.when(size >= power * 2, 1).when((size < power) & (F.col("_near") > _LEAST_EXPONENT), -1).otherwise(0)
    found = found.select(*df.columns, (F.col("_near") + over).alias("_exp"))
    fraction = (size / F.pow(F.lit(2.0), F.col("_exp")) - 1.0) * float(1 << _FRACTION_BITS)
    whole = F.shiftleft((F.col("_exp") + _EXPONENT_BIAS).cast("bigint"), _FRACTION_BITS) + fraction.cast("bigint")
    infinite = F.lit((2 * _EXPONENT_BIAS + 1) << _FRACTION_BITS)
    magnitude = F.when(size == float("inf"), infinite).otherwise(whole)
    signed = F.when(F.col(value) < 0, -magnitude).otherwise(magnitude)
    # Non-nullable: otherwise joins would add null filters below one use of a shared
    # aggregate, which would then run twice.
    return found.select(*df.columns, F.coalesce(signed, F.lit(0).cast("bigint")).alias(code))


def _prefix(digits: int) -> Column:
    """The first ``digits`` digits of the code."""
    return F.shiftright(_CODE, _DIGIT_BITS * (_DIGITS - digits)).alias(f"_p{digits}")


def first_digit(code: str) -> Column:
    """The first of the four digits of a code: runs of neighbouring values, 65,536 at most."""
    return F.shiftright(code, _DIGIT_BITS * (_DIGITS - 1))


def _narrow(*digits_before: str) -> Column:
    """Wanted ranks that fall into this row's run of values, counted from its start.

    The run follows those of the rows with the same group and digits before, and a smaller value.
    """
    window = Window.partitionBy(_GROUP, *digits_before[:-1]).orderBy(digits_before[-1])
    before = F.sum(_COUNT).over(window) - F.col(_COUNT)
    inside = F.filter(_WANTED, lambda w: (w["rank"] >= before) & (w["rank"] < before + F.col(_COUNT)))
    return F.transform(
        inside, lambda w: F.struct(w["slot"].alias("slot"), (w["rank"] - before).alias("rank"),
                                   w["share"].alias("share"))
    ).alias(_WANTED)


def _wanted_ranks(points: Sequence[float]) -> Column:
    """The one or two ranks around every point, with the share of the way between them."""
    ranks = []
    for slot, point in enumerate(points):
        position = F.lit(float(point)) * (F.col("_total") - 1)
        lower = F.floor(position)
        share = position - lower
        for rank in (lower, F.when(share > 0, lower + 1)):
            ranks.append(
                F.struct(F.lit(slot).alias("slot"), rank.alias("rank"), share.alias("share"))
            )
    return F.array(*ranks)


def _interpolated(slot: int) -> Column:
    mine = F.col("slot") == slot
    lower = F.min(F.when(mine, F.col(_VALUE)))
    upper = F.max(F.when(mine, F.col(_VALUE)))
    share = F.max(F.when(mine, F.col("share")))
    return F.when(lower == upper, lower).otherwise(lower + (upper - lower) * share)


def _hits(values: DataFrame, ranks: Column, small: bool) -> DataFrame:
    """The values at the wanted ranks: ``(_g, _v, slot, share)`` from ``(_g, _v, _n)``.

    The ranks that are wanted among rows of equal digits travel with the rows, as part of
    their key in every count.
    """
    total = F.sum(_COUNT).alias(_COUNT)
    some = F.size(_WANTED) > 0
    hint = F.broadcast if small else (lambda table: table)
    coded = with_order_code(values, _VALUE, _CODE).select("*", _prefix(1))
    counts = coded.groupBy(_GROUP, "_p1").agg(total)
    counts = counts.select("*", F.sum(_COUNT).over(Window.partitionBy(_GROUP)).alias("_total"))
    counts = counts.select(_GROUP, "_p1", _COUNT, ranks.alias(_WANTED))
    wanted = counts.select(_GROUP, "_p1", _narrow("_p1")).where(some)
    # Too many groups to broadcast: count first, so that a frequent value is one row
    # before the join moves a digit's values into few tasks.
    key = [_GROUP, "_p1", _VALUE, _CODE]
    if small:
        rows = coded.join(hint(wanted), [_GROUP, "_p1"]).groupBy(*key, _WANTED).agg(total)
    else:
        rows = coded.groupBy(*key).agg(total).join(wanted, [_GROUP, "_p1"])
    for digits in range(2, _DIGITS):
        last, name = f"_p{digits - 1}", f"_p{digits}"
        rows = rows.select(_GROUP, last, _VALUE, _CODE, _COUNT, _WANTED, _prefix(digits))
        counts = rows.groupBy(_GROUP, last, name, _WANTED).agg(total)
        wanted = counts.select(_GROUP, name, _narrow(last, name)).where(some)
        rows = rows.drop(_WANTED).join(hint(wanted), [_GROUP, name])
    ends = rows.select(_GROUP, _VALUE, _narrow(f"_p{_DIGITS - 1}", _CODE))  # one row for each whole code
    return ends.select(_GROUP, _VALUE, F.inline(_WANTED)).select(_GROUP, _VALUE, "slot", "share")


def _answered(hits: DataFrame, names: Sequence[str]) -> DataFrame:
    return hits.groupBy(_GROUP).agg(*[_interpolated(slot).alias(name) for slot, name in enumerate(names)])


def exact_quantiles(
    df: DataFrame,
    value: Column,
    points: Mapping[str, float],
    keys: Sequence[str] = (),
    weight: Column | None = None,
    method: str = "narrow",
    groups_bounded: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per group of ``keys``.

    ``points`` maps output columns to probabilities.  Rows with a missing value or
    key are skipped, so a group without values has no row.  ``weight`` counts a row
    several times.  ``method``: ``narrow`` (see the module text), ``aggregate`` (one
    buffer per group, for groups that fit one) or ``approx`` (``percentile_approx``).
    ``groups_bounded`` states that the keys have few values by construction, which
    saves the check before the ranks are broadcast.
    """
    if method not in {"aggregate", "narrow", "approx"}:
        raise ValueError(f"Unknown quantile method: '{method}'")
    keys = list(keys)
    present = is_present(F.col(_VALUE))
    for key in keys:
        present = present & F.col(key).isNotNull()
    values = df.select(
        *(keys or [F.lit(1).alias("_all")]),
        value.cast("double").alias(_VALUE),
        (F.lit(1) if weight is None else weight).cast("bigint").alias(_COUNT),
    ).where(present)
    names, probabilities = list(points), list(points.values())

    if method != "narrow":
        probe = F.array(*[F.lit(float(p)) for p in probabilities])
        if method == "approx":
            found = F.percentile_approx(_VALUE, probe, 10_000)
        else:
            found = F.percentile(_VALUE, probe, F.col(_COUNT) if weight is not None else 1)
        table = values.groupBy(*keys).agg(found.alias("_q"))
        table = table if keys else table.where(F.col("_q").isNotNull())
        return table.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])

    small = groups_bounded or not keys or few_groups(values, keys)
    named = values.select(F.struct(*(keys or ["_all"])).alias(_GROUP), _VALUE, _COUNT)
    answers = _answered(_hits(named, _wanted_ranks(probabilities), small), names)
    return answers.select(*[F.col(_GROUP)[k].alias(k) for k in keys], *names)


def quantile_answers(df: DataFrame, requests: Mapping[str, Request]) -> DataFrame:
    """The quantiles of many requests, found in two scans of ``df`` together.

    Each row of ``df`` is read once per scan and counted for every request; the digits of all requests
    are narrowed together.  The answers are one small table, a row per request and group, of which
    ``quantiles_of`` selects the rows of one request.
    """
    keys = sorted({key for request in requests.values() for key in request.keys})
    kind = "array<struct<slot:int,rank:bigint,share:double>>"
    entries, ranks = [], F.array().cast(kind)
    for i, request in enumerate(requests.values()):
        value = request.value.cast("double")
        for key in request.keys:
            value = F.when(F.col(key).isNotNull(), value)
        own = [(F.col(key) if key in request.keys else F.lit(None).cast(df.schema[key].dataType)).alias(key)
               for key in keys]
        entries.append(F.struct(F.struct(F.lit(i).alias("request"), *own).alias(_GROUP), value.alias(_VALUE)))
        mine = _wanted_ranks(list(request.points.values())).cast(kind)
        ranks = F.when(F.col(_GROUP)["request"] == i, mine).otherwise(ranks)
    values = df.select(F.inline(F.array(*entries))).where(is_present(F.col(_VALUE)))
    values = values.select(_GROUP, _VALUE, F.lit(1).cast("bigint").alias(_COUNT))
    small = all(r.groups_bounded or not r.keys or few_groups(df, list(r.keys)) for r in requests.values())
    width = max(len(request.points) for request in requests.values())
    return _answered(_hits(values, ranks, small), [f"_q{i}" for i in range(width)])


def quantiles_of(answers: DataFrame, requests: Mapping[str, Request], name: str) -> DataFrame:
    """The result of one request from the table of all answers."""
    request = requests[name]
    return answers.where(F.col(_GROUP)["request"] == list(requests).index(name)).select(
        *[F.col(_GROUP)[key].alias(key) for key in request.keys],
        *[F.col(f"_q{slot}").alias(point) for slot, point in enumerate(request.points)])
