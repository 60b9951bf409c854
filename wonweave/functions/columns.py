"""Columns for numbers, keys and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WON = T.DecimalType(20, 0)
SEPARATOR = "\x1f"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def won(c: Column | str) -> Column:
    """An amount in won; null and what is no number are 0."""
    number = F.expr("try_cast(NULL AS DOUBLE)") if c is None else col(c).try_cast("double")
    return F.coalesce(F.when(~F.isnan(number) & (F.abs(number) < 1e19), F.bround(number)).try_cast(WON), F.lit(0).cast(WON))


def number_or_null(c: Column | str, kind: str = "double") -> Column:
    """Without thousands separators; null if blank or no number."""
    return F.trim(F.replace(col(c).cast("string"), F.lit(","), F.lit(""))).try_cast(kind)


def strict_number(c: Column | str, kind: str = "double") -> Column:
    """Fails on what is no number (ANSI cast)."""
    return col(c).cast(kind)


def integral(c: Column | str) -> Column:
    """As text: without a fraction if it has none."""
    number = col(c).cast("double")
    return F.when(number == F.floor(number), F.floor(number).cast("string")).otherwise(number.cast("string"))


def same_amount(a: Column | str, b: Column | str, within: float = 0.5) -> Column:
    return F.abs(col(a).cast("double") - col(b).cast("double")) <= within


def cents(c: Column | str) -> Column:
    """Whole cents of a double amount: sums of these are exact."""
    return F.round(col(c) * 100).cast("long")


def share(part: Column | str, whole: Column | str, places: int = 6, empty: float | None = 0.0) -> Column:
    """part / whole, rounded half to even; `empty` where the whole is null or 0."""
    return F.when(F.coalesce(col(whole), F.lit(0)) != 0, F.bround(col(part).cast("double") / col(whole).cast("double"), places)).otherwise(F.lit(empty).cast("double"))


def rate(part: Column | str, whole: Column | str, places: int = 6) -> Column:
    return share(part, whole, places, None)


def key(*columns: Column | str) -> Column:
    """Composite key, as an array of strings; nulls are empty strings."""
    return F.array(*[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])


def trimmed_key(k: Column | str) -> Column:
    """For comparison: all parts trimmed."""
    return F.transform(col(k), lambda x: F.trim(x))


def is_key(k: Column | str, parts: int = 6) -> Column:
    return F.coalesce((F.size(col(k)) == parts) & ~F.exists(col(k), lambda x: F.trim(x) == ""), F.lit(False))


def stable_id(prefix: str, k: Column | str, length: int = 16) -> Column:
    """prefix-<first hex digits of the sha256 of the key's parts>."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(F.array_join(col(k), SEPARATOR), 256), 1, length))


def year_text(c: Column | str) -> Column:
    return F.regexp_replace(F.trim(col(c).cast("string")), r"\.0+$", "")


def first_filled(*columns: Column | str) -> Column:
    """The first that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(col(c).cast("string")) != "", col(c).cast("string")) for c in columns])


#: Units of won amounts, the largest first.
UNITS = {"조": 10**12, "억": 10**8, "백만": 10**6}


def korean_amount(c: Column | str, largest: str = "조") -> Column:
    """A won amount in units of 10^12, 10^8 or 10^6 with one decimal, in none over `largest`."""
    amount, names = col(c).cast("double"), list(UNITS)
    out = F.format_number(amount, 0)
    for name in reversed(names[names.index(largest) :]):
        out = F.when(F.abs(col(c)) >= UNITS[name], F.concat(F.format_number(amount / UNITS[name], 1), F.lit(name))).otherwise(out)
    return out


def percent(c: Column | str) -> Column:
    return F.when(col(c).isNull(), "-").otherwise(F.concat(F.format_number(col(c) * 100, 1), F.lit("%")))


def date_label(c: Column | str) -> Column:
    return F.concat_ws(".", F.substring(col(c), 1, 4), F.substring(col(c), 5, 2), F.substring(col(c), 7, 2))


def is_snapshot_date(c: Column | str, year: Column | str) -> Column:
    """YYYYMMDD, a real date of the year."""
    day = col(c).cast("string")
    return F.coalesce(day.rlike(r"^\d{8}$") & day.startswith(col(year).cast("string")) & F.try_to_date(day, "yyyyMMdd").isNotNull(), F.lit(False))


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)
