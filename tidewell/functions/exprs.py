"""Column expressions shared by all domains: ratios, rounding, money, dates, rule labels, masks.

Everything here is built from JVM-side functions, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.element_at(F.transform(F.array(value), body), 1)


def round_n(value: ColumnLike, digits: int) -> Column:
    """Round half away from zero on the binary value, so other SQL engines agree on ties."""
    scale = F.lit(float(10**digits))
    return F.round(as_col(value) * scale) / scale


def round_half_even(value: ColumnLike, digits: int) -> Column:
    """Round ties to the even neighbour, as data-frame libraries do."""
    scale = F.lit(float(10**digits))
    return F.rint(as_col(value) * scale) / scale


def safe_ratio(part: ColumnLike, whole: ColumnLike, digits: int | None = 4) -> Column:
    """part / whole in double precision; NULL when the denominator is 0 or NULL."""
    ratio = F.try_divide(as_col(part).cast("double"), as_col(whole).cast("double"))
    return ratio if digits is None else round_n(ratio, digits)


def money_sum(value: ColumnLike, scale: int = 2) -> Column:
    """Order-independent sum: exact decimal addition, handed back as double."""
    return F.sum(as_col(value).cast(f"decimal(18,{scale})")).cast("double")


def money_avg(value: ColumnLike, scale: int = 2) -> Column:
    return F.try_divide(money_sum(value, scale), F.count(as_col(value)).cast("double"))


def rate(condition: Column) -> Column:
    """Share of rows meeting the condition; a NULL condition counts as not met."""
    return F.try_divide(F.count_if(condition).cast("double"), F.count(F.lit(1)).cast("double"))


def int_avg(value: ColumnLike) -> Column:
    """Mean of an integer column through an exact integer sum."""
    return F.try_divide(F.sum(as_col(value)).cast("double"), F.count(as_col(value)).cast("double"))


def boundaries_crossed(unit: str, start: ColumnLike, end: ColumnLike) -> Column:
    """Number of `unit` boundaries between two timestamps (00:59 -> 01:01 is one hour)."""
    return F.timestamp_diff(unit, F.date_trunc(unit, as_col(start)), F.date_trunc(unit, as_col(end)))


def hour_start(value: ColumnLike) -> Column:
    return F.date_trunc("HOUR", as_col(value)).cast("timestamp_ntz")


def capped(value: ColumnLike, limit: float = 1.0) -> Column:
    return F.least(as_col(value).cast("double"), F.lit(float(limit)))


def clamp(value: ColumnLike, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), as_col(value)))


def label(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """First matching rule wins, as in an ordered CASE."""
    result = None
    for condition, name in rules:
        result = F.when(condition, F.lit(name)) if result is None else result.when(condition, F.lit(name))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def label_last_wins(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    """Rules applied one after another, each overwriting the earlier ones."""
    return label(list(reversed(rules)), default)


def any_of(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def clean_money(text: ColumnLike) -> Column:
    """Currency text to double. Empty and NULL are 0; any other unparseable text fails the job."""
    stripped = F.trim(F.regexp_replace(as_col(text), "[¥,]", ""))
    return F.when(stripped.isNull() | (stripped == ""), F.lit(0.0)).otherwise(stripped.cast("double"))


def parse_mixed_date(text: ColumnLike, patterns: Sequence[str] = ("yyyy/M/d", "yyyy-MM-dd", "yyyyMMdd")) -> Column:
    """First pattern that parses, else NULL."""
    trimmed = F.trim(as_col(text))
    return F.coalesce(*[F.try_to_timestamp(trimmed, F.lit(p)).cast("date") for p in patterns])


def map_values(value: ColumnLike, mapping: dict[str, str]) -> Column:
    """Replace mapped values, pass the rest through."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(table, as_col(value)), as_col(value))


def mask_middle(value: ColumnLike, head: int = 3, tail: int = 4) -> Column:
    """Keep the first and last characters; text too short to hide anything is masked whole."""
    text = as_col(value)
    hidden = F.length(text) - head - tail
    return F.when(hidden <= 0, F.repeat(F.lit("*"), F.length(text))).otherwise(
        F.concat(F.substring(text, 1, head), F.repeat(F.lit("*"), hidden), F.right(text, F.lit(tail)))
    )


def mask_head(value: ColumnLike, tail: int = 4) -> Column:
    """Keep only the last characters."""
    return mask_middle(value, 0, tail)


def hash_id(value: ColumnLike) -> Column:
    return F.sha2(as_col(value).cast("string"), 256)
