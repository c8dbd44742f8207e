"""Row functions used across the operators. All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# City names that are reported under another name.
CITY_ALIASES = {"北京索迪": "北京"}


def city_alias(city: Column, aliases: dict[str, str] = CITY_ALIASES) -> Column:
    """Report an aliased city under its main name."""
    out = city
    for name, main in aliases.items():
        out = F.when(city == name, F.lit(main)).otherwise(out)
    return out


def mac_prefix(mac: Column, ignore_case: bool = True) -> Column:
    """Vendor part of a mac address: its first six characters."""
    prefix = F.substring(mac, 1, 6)
    return F.lower(prefix) if ignore_case else prefix


def version_part(packed: Column) -> Column:
    """Version in a packed schedule version whose last two digits are the batch."""
    return F.substring(packed, F.lit(1), F.length(packed) - 2)


def batch_part(packed: Column) -> Column:
    """Two-digit batch at the end of a packed schedule version, as an integer."""
    return F.substring(packed, F.length(packed) - 1, F.lit(2)).try_cast("int")


def short_version(packed: Column) -> Column:
    """First six characters of versions of seven or more characters, else all of it."""
    return F.when(F.length(packed) >= 7, F.substring(packed, 1, 6)).otherwise(packed)


def file_stem(name: Column, skip: int = 0) -> Column:
    """File name without its four-character extension and without ``skip`` leading characters."""
    trimmed = F.trim(name)
    return F.substring(trimmed, F.lit(1 + skip), F.length(trimmed) - 4 - skip)


def null_if_sentinel(value: Column) -> Column:
    """Empty strings and the text NULL mean a missing value."""
    return F.when(value.isin("", "NULL"), F.lit(None)).otherwise(value)


def wanted(column: Column, value: str | None) -> Column:
    """Equality test that is skipped when no value is asked for."""
    return F.lit(True) if value in (None, "") else column == F.lit(value)
