"""Money: cents conversion (F1, F4) and exact decimal arithmetic (F8).

All helpers return Column expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tallyflow.constants import CENTS_PER_UNIT, DEFAULT_DIV_SCALE


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_cents(amount: Column | str, mode: str = "exact") -> Column:
    """money (double) to integral cents.

    ``exact`` rounds to the nearest cent through a decimal, so 19.99 -> 1999.
    ``truncate`` reproduces a plain ``(long)(x * 100)``: the binary product of
    19.99 * 100 is 1998.99..., which truncates to 1998.
    """
    amount = _c(amount)
    if mode == "exact":
        return (amount.cast(DecimalType(18, 2)) * F.lit(CENTS_PER_UNIT)).cast("long")
    if mode == "truncate":
        return (amount * F.lit(float(CENTS_PER_UNIT))).cast("long")
    raise ValueError(f"unknown cents mode {mode!r}")


def from_cents(cents: Column | str) -> Column:
    """integral cents to money as a double (``cents / 100.0``)."""
    return _c(cents).cast("double") / F.lit(float(CENTS_PER_UNIT))


# --- F8: exact arithmetic ---------------------------------------------------
# A double stands for its shortest decimal form. Where both operands have at
# most 9 decimals and fewer than 10 digits before the point, they are small
# decimals and the operation is one decimal operation. Everything else goes
# through (integer digits, power of ten): the digits are combined exactly and
# the result is read back as a double once, so no operand is ever rounded.
# What 38 digits cannot hold (a quotient whose scale asks for more) is an
# error, never a rounded value. NaN and infinities are errors too.

_SMALL_T = DecimalType(19, 9)
_INT_T = DecimalType(38, 0)


def _small(v: Column) -> Column:
    """The operand as a small decimal; null when it is not exactly one."""
    d = v.try_cast(_SMALL_T)
    return F.when(d.cast("double") == v, d)


def _parts(v: Column) -> tuple[Column, Column]:
    """(digits, exponent): v = digits * 10 ** exponent."""
    text = v.cast("string")
    mantissa = F.regexp_extract(text, r"^(-?[0-9]+\.[0-9]+)", 1)
    power = F.regexp_extract(text, r"E(-?[0-9]+)$", 1)
    decimals = F.length(F.substring_index(mantissa, ".", -1))
    digits = F.when(text.isNull(), F.lit(None)).otherwise(
        F.coalesce(
            F.translate(mantissa, ".", "").try_cast(_INT_T), F.raise_error(F.concat(F.lit("not a number: "), text)).cast(_INT_T)
        )
    )
    return digits, F.coalesce(power.try_cast("int"), F.lit(0)) - decimals


def _double(digits: Column, exponent: Column) -> Column:
    return F.concat(digits.cast("string"), F.lit("E"), exponent.cast("string")).cast("double")


def _fits(digits: Column, by: Column) -> Column:
    """Whether digits * 10 ** by has at most 37 digits."""
    return F.length(F.abs(digits).cast("string")) + by <= 37


def _shifted(digits: Column, by: Column) -> Column:
    """digits * 10 ** by, for by >= 0 that fits."""
    return (digits * F.rpad(F.lit("1"), by + 1, "0").cast(_INT_T)).cast(_INT_T)


def _wide(a: Column, b: Column, body) -> Column:
    """``body`` of both operands' parts, taken apart once. A lambda is not
    compiled into the stage's code, which the general case would overgrow."""
    (da, ea), (db, eb) = _parts(a), _parts(b)
    names = ("a", "b", "da", "ea", "db", "eb")
    parts = F.struct(*(c.alias(n) for c, n in zip((a, b, da, ea, db, eb), names, strict=True)))
    return F.transform(F.array(parts), lambda p: body(*(p[n] for n in names)))[0]


def _aligned(a: Column, b: Column, da: Column, ea: Column, db: Column, eb: Column) -> Column:
    gap = ea - eb
    # Digits that do not fit after alignment: the other operand's first digit
    # is 20 places below, where it changes nothing in a double.
    return (
        F.when(da == 0, b)
        .when(db == 0, a)
        .when((gap >= 0) & ~_fits(da, gap), a)
        .when((gap < 0) & ~_fits(db, -gap), b)
        .when(gap >= 0, _double(_shifted(da, gap) + db, eb))
        .otherwise(_double(da + _shifted(db, -gap), ea))
    )


def _sum(a: Column, b: Column) -> Column:
    sa, sb = _small(a), _small(b)
    return F.when(sa.isNotNull() & sb.isNotNull(), (sa + sb).cast("double")).otherwise(_wide(a, b, _aligned))


def exact_add(a: Column | str, b: Column | str) -> Column:
    return _sum(_c(a), _c(b))


def exact_sub(a: Column | str, b: Column | str) -> Column:
    return _sum(_c(a), -_c(b))


def exact_mul(a: Column | str, b: Column | str) -> Column:
    a, b = _c(a), _c(b)
    sa, sb = _small(a), _small(b)

    def product(a, b, da, ea, db, eb):
        return _double(da.cast(DecimalType(18, 0)) * db.cast(DecimalType(18, 0)), ea + eb)

    return F.when(sa.isNotNull() & sb.isNotNull(), (sa * sb).cast("double")).otherwise(_wide(a, b, product))


def _quotient(scale: int):
    def body(a, b, da, ea, db, eb):
        # a / b * 10 ** scale = da * 10 ** by / db, rounded to an integer.
        by = ea - eb + F.lit(scale)
        over = F.raise_error(F.lit("the quotient has more digits than 38")).cast(_INT_T)
        num = F.when(by <= 0, da).when(_fits(da, by), _shifted(da, by)).otherwise(over)
        den = F.when(by >= 0, db).when(_fits(db, -by), _shifted(db, -by)).otherwise(F.lit(None).cast(_INT_T))
        n, d = F.abs(num), F.abs(den)
        rest = n % d
        whole = ((n - rest) / d).cast(_INT_T) + F.when(rest >= d - rest, F.lit(1)).otherwise(F.lit(0))
        sign = F.when((da < 0) != (db < 0), F.lit("-")).otherwise(F.lit(""))
        rounded = F.concat(sign, whole.cast("string"), F.lit(f"E-{scale}")).cast("double")
        return (
            F.when(db == 0, a / b)
            .when((da == 0) | ((by < 0) & ~_fits(db, -by) & da.isNotNull()), F.lit(0.0))  # far below half a unit
            .otherwise(rounded)
        )

    return body


def exact_div(a: Column | str, b: Column | str, scale: int = DEFAULT_DIV_SCALE) -> Column:
    """Quotient rounded HALF_UP to ``scale`` decimals.

    A zero divisor is an error, as in ANSI mode. A negative scale is rejected
    when the expression is built.
    """
    if scale < 0:
        raise ValueError("scale must be a positive integer or zero")
    a, b = _c(a), _c(b)
    wide = _wide(a, b, _quotient(scale))
    if scale > 17:
        return wide
    # Small operands: Spark's quotient has 19 decimals. Rounding it again is
    # right unless it lies on a boundary, which the first rounding may have
    # moved it to.
    q = _small(a) / _small(b)
    once = F.round(q, scale)
    half = F.lit(Decimal(5).scaleb(-scale - 1)).cast(DecimalType(scale + 2, scale + 1))
    return F.when(F.abs(q - once) != half, once.cast("double")).otherwise(wide)


def exact_round(v: Column | str, scale: int) -> Column:
    """Round HALF_UP on the decimal form of the double."""
    if scale < 0:
        raise ValueError("scale must be a positive integer or zero")
    v = _c(v)
    small = _small(v)
    rounded = F.round(small, scale).cast("double") if scale < 9 else v
    return F.when(small.isNotNull(), rounded).otherwise(_wide(v, F.lit(1.0), _quotient(scale)))
