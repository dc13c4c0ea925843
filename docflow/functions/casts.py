"""Safe casts and text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def safe_date(text: Column) -> Column:
    """ISO date, NULL for anything else (``'2024'`` and ``'01/15/2024'`` included)."""
    return F.try_to_date(text, "yyyy-MM-dd")


def strict_date(text: Column) -> Column:
    """Blank becomes NULL; any other non-date raises under ANSI mode."""
    return F.when(F.trim(text) != "", F.to_date(F.trim(text), "yyyy-MM-dd"))


def safe_decimal(text: Column, precision: int = 38, scale: int = 0) -> Column:
    """NULL when the text is not a number; excess digits round half up."""
    return text.try_cast(f"decimal({precision},{scale})")


def clean_money(text: Column, precision: int = 18, scale: int = 2) -> Column:
    """Form amounts: ``$``, commas and blanks removed; NULL, blank or unreadable become 0."""
    digits = F.regexp_replace(F.trim(text), r"[$,]", "")
    number = safe_decimal(F.trim(digits), precision, scale)
    return F.coalesce(number, F.lit(0).cast(f"decimal({precision},{scale})"))


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed, so 00:00:00.9 to 00:00:02.1 is 2."""
    def secs(c: Column) -> Column:
        return F.unix_seconds(F.date_trunc("SECOND", c).cast("timestamp"))

    return secs(end) - secs(start)


def size_kb(size: Column) -> Column:
    return F.round(size.cast("decimal(20,4)") / 1024, 2).cast("decimal(18,2)")


def size_category(size: Column) -> Column:
    return (
        F.when(size < 100000, "Small (<100KB)")
        .when(size < 500000, "Medium (100-500KB)")
        .otherwise("Large (>500KB)")
    )


def status_icon(status: Column) -> Column:
    return F.when(status == "SUCCESS", "✓").otherwise("✗")


def file_stem(name: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def file_extension(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def ago(as_of: str, unit: str, n: int) -> Column:
    """``as_of`` minus ``n`` units; folds to a literal, so it can be pushed to the scan."""
    return F.expr(f"timestampadd({unit}, -{int(n)}, TIMESTAMP_NTZ'{as_of}')")


def at(as_of: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{as_of}'")
