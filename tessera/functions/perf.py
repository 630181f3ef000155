"""Column functions on benchmark figures: summaries, ratios, significance, units, prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"([\d.]+(?:[eE][+-]?\d+)?)"
#: Seconds in a unit of the benchmark formats.
SECONDS = {"s": 1.0, "ms": 1e-3, "us": 1e-6, "ns": 1e-9}


def _labelled(text: Column, label: str) -> Column:
    found = F.regexp_extract(text, rf"{label}:\s*{NUMBER}", 1)
    return F.when(found != "", found).try_cast("double")


def perf_by_label(text: Column) -> Column:
    """Struct of four figures found by label, the older form with the deviation in brackets included; null if one is missing."""
    means = {k: _labelled(text, rf"{k}\s+Mean") for k in ("Before", "After")}
    apart = {k: _labelled(text, rf"{k}\s+SD") for k in ("Before", "After")}
    inline = {k: F.nullif(F.regexp_extract(text, rf"{k}\s+Mean:\s*{NUMBER}\s*\(SD:\s*{NUMBER}\)", 2), F.lit("")).try_cast("double") for k in ("Before", "After")}
    both_apart = apart["Before"].isNotNull() & apart["After"].isNotNull()
    sd = {k: F.when(both_apart, apart[k]).otherwise(inline[k]) for k in ("Before", "After")}
    parts = (means["Before"], sd["Before"], means["After"], sd["After"])
    names = ("before_mean", "before_sd", "after_mean", "after_sd")
    whole = means["Before"].isNotNull()
    for p in parts[1:]:
        whole = whole & p.isNotNull()
    return F.when(whole, F.struct(*[p.alias(n) for p, n in zip(parts, names, strict=True)]))


def perf_by_position(text: Column, strict: bool = False) -> Column:
    """Struct of four figures, the value behind the first colon of lines one to four; all zero if one cannot be read.

    strict: raise instead.
    """
    lines = F.split(F.regexp_replace(text, r"^\s+|\s+$", ""), "\r\n|\n|\r")
    value = [F.trim(F.get(F.split(F.get(lines, F.lit(i)), ":"), F.lit(1))) for i in range(4)]
    names = ("before_mean", "before_sd", "after_mean", "after_sd")
    if strict:
        return F.struct(*[v.cast("double").alias(n) for v, n in zip(value, names, strict=True)])
    number = [v.try_cast("double") for v in value]
    good = number[0].isNotNull() & number[1].isNotNull() & number[2].isNotNull() & number[3].isNotNull()
    return F.struct(*[F.when(good, n).otherwise(0.0).alias(name) for n, name in zip(number, names, strict=True)])


def speedup_ratio(before: Column, after: Column) -> Column:
    """before / after; 1 where after is zero or either is missing."""
    return F.coalesce(F.when(after != 0, before / after), F.lit(1.0))


def improvement_pct(before: Column, after: Column) -> Column:
    """(before - after) / before * 100; 0 where before is zero."""
    return F.when(before != 0, (before - after) / before * 100).otherwise(0.0)


def is_significant(before: Column, after: Column, after_sd: Column, sigma: float = 2.0) -> Column:
    """before - after > sigma * after_sd; never where it did not get faster; without deviation any gain counts."""
    return F.when(after >= before, False).when(after_sd == 0, before - after > 0).otherwise(before - after > sigma * after_sd)


def positive_finite(x: Column) -> Column:
    return F.coalesce(x.isNotNull() & ~F.isnan(x) & (x > 0) & (x < float("inf")), F.lit(False))


def to_seconds(value: Column, unit: Column) -> Column:
    """value in seconds; an unknown unit raises."""
    factor = F.element_at(F.create_map(*[F.lit(v) for pair in SECONDS.items() for v in pair]), F.coalesce(unit, F.lit("?")))
    return F.when(factor.isNull(), F.raise_error(F.concat(F.lit("unknown time unit: "), F.coalesce(unit, F.lit("null"))))).otherwise(value * factor)


def harmonic_mean(x: Column, floor: float | None = 0.001) -> Column:
    """n / sum(1 / max(x, floor)) over the rows, NaN counted in n only; 0 over no rows.

    Without a floor a zero makes the mean zero.
    """
    n = F.count(F.lit(1))
    clean = F.nanvl(x, F.lit(None).cast("double"))
    if floor is None:
        broken = F.max(F.when(clean == 0, 1).otherwise(0))
        return F.when((n == 0) | (broken == 1), 0.0).otherwise(F.coalesce(F.try_divide(n, F.sum(F.when(clean != 0, 1 / clean))), F.lit(0.0)))
    return F.coalesce(F.try_divide(n, F.sum(F.when(clean.isNotNull(), 1 / F.greatest(clean, F.lit(floor))))), F.lit(0.0))


def harmonic_mean_positive(x: Column) -> Column:
    """Over positive finite values only, null if there are none."""
    good = F.when(positive_finite(x), x)
    return F.try_divide(F.count(good), F.sum(1 / good))


def geometric_mean(x: Column) -> Column:
    """Over positive finite values only, null if there are none."""
    return F.exp(F.avg(F.ln(F.when(positive_finite(x), x))))


def token_cost(input_tokens: Column, cached_tokens: Column, output_tokens: Column, input_price: Column, cached_price: Column, output_price: Column) -> Column:
    """Exact price in decimals, prices per million tokens; more cached than input tokens raises."""
    dec = lambda c: c.cast("decimal(20,6)")
    fresh = input_tokens - cached_tokens
    total = (dec(fresh) * dec(input_price) + dec(cached_tokens) * dec(cached_price) + dec(output_tokens) * dec(output_price)) / F.lit(1_000_000).cast("decimal(10,0)")
    return F.when(fresh < 0, F.raise_error(F.lit("more cached than input tokens"))).otherwise(total.cast("decimal(38,10)"))
