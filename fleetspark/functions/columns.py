"""Column expressions: text cleaning, typed parsing, exact averages, ratios, bands."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from ..schemas import STAR_DIGITS

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- cleaning ---------------------------------------------------------------

# Characters that count as white space around a text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: ColumnLike) -> Column:
    """Remove any white space around a text (plain ``trim`` removes only spaces)."""
    return F.btrim(col(c), F.lit(WHITESPACE))


def upper_strip(c: ColumnLike) -> Column:
    return F.upper(strip(c))


def to_number(c: ColumnLike, type_: str = "decimal(28,8)") -> Column:
    """Text as a number: NULL where it is none (``nan`` and infinity are none), an error where it is
    a number that the type cannot hold: too wide, or with a fraction for a whole one.

    A decimal has the fraction digits of its type, rounded.
    """
    text = col(c).cast("string")
    value = text.try_cast("double")
    number = F.abs(value) < F.lit(float("inf"))  # NaN is no less than that
    if type_ == "double":
        return F.when(number, value)
    fits = text.try_cast(type_)
    other = F.raise_error(F.concat(F.lit(f"number does not fit {type_}: "), text)).cast(type_)
    # a failed cast costs an exception, so text without a number is told by how it starts (whole ones skip control characters)
    starts = text > ""
    if type_ in ("int", "long"):  # what a CSV holds once its column had a gap is 12000.0
        exact = text.try_cast("decimal(38,10)")
        other = F.coalesce(F.when(exact == F.floor(exact), exact.try_cast(type_)), other)
    else:
        starts &= text < ":"
    # plain text that the type reads is such a number; only the rest is looked at more closely. Few casts keep the code
    # generated for a feed's columns below the 8,000 bytes that the JVM compiles
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(starts & (plain | number), F.coalesce(fits, F.when(number, other)))


def to_date_br(c: ColumnLike) -> Column:
    """``dd/mm/yyyy`` text as a date, NULL when it is no such date."""
    return F.try_to_date(col(c), "d/M/yyyy")


def year_of_period(c: ColumnLike) -> Column:
    """First four digits of a period such as ``2023`` or ``202305``."""
    return F.substring(col(c).cast("string"), 1, 4).try_cast("int")


# --- exact arithmetic ---------------------------------------------------------
#
# Averages and sums of decimal columns run on whole numbers of the column's last digit: a 64-bit
# sum is exact, does not depend on how rows are spread over tasks, and costs a third of a sum in
# the 128-bit decimal that Spark would widen to. Results become decimals again once per group.

RATIO_DIGITS = 10
LOW_BITS = 20


@dataclass(frozen=True)
class Measure:
    """A number per row as whole units of 10^-digits.

    A measure whose units are too fine for a 64-bit sum over very many rows is ``wide``: its high
    and low bits are summed apart and put together once per group.
    """

    units: Column
    digits: int
    wide: bool = False

    def sum(self) -> Column:
        if not self.wide and raises_overflow():
            return F.sum(self.units)
        high = F.sum(F.shiftright(self.units, LOW_BITS)).cast("decimal(20,0)")
        low = F.sum(self.units.bitwiseAND(F.lit(2**LOW_BITS - 1).cast("long"))).cast("decimal(20,0)")
        return (high * F.lit(Decimal(2**LOW_BITS)) + low).cast("decimal(28,0)")

    def count(self) -> Column:
        return F.count(self.units)


def raises_overflow() -> bool:
    """Whether sums and casts of the session fail on overflow (ANSI). Where they would wrap or give NULL instead,
    sums are wide and casts checked."""
    session = SparkSession.getActiveSession()
    return session is None or session.conf.get("spark.sql.ansi.enabled") == "true"


def kept_cast(c: ColumnLike, type_: str) -> Column:
    """A cast that fails on a value which the type cannot hold, whatever the session's setting."""
    if raises_overflow():
        return col(c).cast(type_)
    error = F.raise_error(F.concat(F.lit(f"number does not fit {type_}: "), col(c).cast("string"))).cast(type_)
    return F.coalesce(col(c).try_cast(type_), F.when(col(c).isNotNull(), error))


def fixed(c: ColumnLike, digits: int) -> Measure:
    """A column with at most ``digits`` decimals (up to 9e15 units)."""
    return Measure(kept_cast(F.rint(col(c).cast("double") * float(10**digits)), "long"), digits)


def per(num: ColumnLike, den: ColumnLike) -> Measure:
    """Row-level quotient to ten digits; NULL where the divisor is zero."""
    quotient = col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0))
    return Measure(fixed(quotient, RATIO_DIGITS).units, RATIO_DIGITS, wide=True)


def measure(c: str | Measure) -> Measure:
    """A star measure by name, with the digits of its table type."""
    if isinstance(c, Measure):
        return c
    digits = STAR_DIGITS[c]
    return fixed(c, digits) if digits else Measure(F.col(c).cast("long"), 0)


def from_units(units: Column, digits: int) -> Column:
    """Whole units as a decimal; a count of whole things stays an integer."""
    if not digits:
        return kept_cast(units, "long")
    value = units.cast("decimal(24,0)") * F.lit(Decimal(1).scaleb(-digits))
    return value.cast(f"decimal(26,{digits})")


def _quotient(units: Column, count: Column, digits: int) -> Column:
    """Sum over count. The width chosen keeps 20 digits of the quotient."""
    value = units.cast("decimal(24,0)") * F.lit(Decimal(1).scaleb(-digits))
    return value.cast("decimal(28,10)") / F.nullif(count, F.lit(0))


def total(c: str | Measure) -> Column:
    """Exact sum."""
    m = measure(c)
    return from_units(m.sum(), m.digits)


def exact_mean(c: str | Measure) -> Column:
    """Exact sum divided once; NULL for an empty group."""
    m = measure(c)
    return _quotient(m.sum(), m.count(), m.digits)


def mean(c: str | Measure, digits: int) -> Column:
    """Mean, rounded half away from zero."""
    return F.round(exact_mean(c), digits)


def decimal_mean(c: ColumnLike) -> Column:
    """``exact_mean`` for a decimal column too wide for 64 bits."""
    return F.sum(col(c)) / F.nullif(F.count(col(c)), F.lit(0))


def ratio(num: ColumnLike, den: ColumnLike) -> Column:
    """Quotient of two decimals; NULL where the divisor is zero."""
    return col(num) / F.nullif(col(den), F.lit(0))


def ratio_or_zero(num: ColumnLike, den: ColumnLike) -> Column:
    """Quotient where the divisor is positive, else 0 (also for a NULL divisor)."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(0))


def rounded_quotient(num: Column, den: Column, digits: int) -> Column:
    """Quotient of two whole decimals as whole units of 10^-digits, rounded half away from zero by whole
    numbers alone; NULL where the divisor is zero. ``num`` comes in those units."""
    up = F.call_function("div", F.abs(num) * 2 + den, F.nullif(den, F.lit(0)) * 2)
    return (F.signum(num).cast("decimal(1,0)") * up.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(22,{digits})")


def percent(num: ColumnLike, den: ColumnLike, digits: int) -> Column:
    """``num`` as a percentage of ``den``."""
    return F.round(ratio(num, den) * 100, digits)


def share(num: str, den: str, digits: int) -> Column:
    """Sum of one measure as a percentage of the sum of another with the same digits."""
    return _unit_share(measure(num).sum(), measure(den).sum(), digits)


def _unit_share(num: Column, den: Column, digits: int) -> Column:
    return percent(num.cast("decimal(24,0)"), den.cast("decimal(24,0)"), digits)


def round_floor(c: ColumnLike, digits: int) -> Column:
    """Round a double half up by ``floor``, the same in every IEEE engine. One too large to have such digits
    (and for the whole number that ``floor`` makes) stays as it is."""
    scale = float(10**digits)
    up = col(c) * F.lit(scale) + F.lit(0.5)
    return F.when(F.abs(up) < F.lit(2.0**53), F.floor(up).cast("double")).otherwise(up) / F.lit(scale)


# --- partial sums: aggregate by key first, join dimensions on the small result ----

def partials(
    sums: Iterable[str] = (), means: Iterable[str] = (), ratios: Mapping[str, Measure] | None = None,
) -> list[Column]:
    """First-stage aggregates in units: ``s_x`` for every measure, ``n_x`` for averaged ones."""
    averaged = {c: measure(c) for c in means} | dict(ratios or {})
    every = {c: measure(c) for c in sums} | averaged
    return [m.sum().alias(f"s_{c}") for c, m in every.items()] + [
        m.count().alias(f"n_{c}") for c, m in averaged.items()
    ]


def _merged(c: str) -> Column:
    return F.sum(F.col(f"s_{c}").cast("decimal(28,0)"))


def merged_exact(c: str, unit: int | None = None) -> Column:
    """Second-stage mean over ``partials`` rows; ``unit`` are the digits of a ratio."""
    return _quotient(_merged(c), F.sum(f"n_{c}"), STAR_DIGITS[c] if unit is None else unit)


def merged_mean(c: str, digits: int, unit: int | None = None) -> Column:
    return F.round(merged_exact(c, unit), digits)


def merged_sum(c: str) -> Column:
    return from_units(_merged(c), STAR_DIGITS[c])


def merged_share(num: str, den: str, digits: int) -> Column:
    return _unit_share(_merged(num), _merged(den), digits)


# --- classification ---------------------------------------------------------------

def upper_bound_band(c: ColumnLike, bounds: Sequence[tuple[int, str]], above: str) -> Column:
    """Label of the first bound not exceeded; ``above`` beyond the last one and for NULL."""
    out = None
    for limit, label in bounds:
        test = col(c) <= F.lit(limit)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(above))


def range_band(c: ColumnLike, ranges: Sequence[tuple[int, int, str]], default: str) -> Column:
    """Label of the inclusive range holding the value; ``default`` outside all and for NULL."""
    out = None
    for low, high, label in ranges:
        test = col(c).between(low, high)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(default))


def lookup(key: Column, table: Mapping[str, str], default: str) -> Column:
    """Constant lookup table as a map literal."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


# --- frames -----------------------------------------------------------------------

def decimals_as_double(df: DataFrame) -> DataFrame:
    """Same rows with decimal columns as doubles, for clients without a decimal type."""
    return df.select(
        *(F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
          else F.col(f"`{f.name}`") for f in df.schema.fields)
    )
