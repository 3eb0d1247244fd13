"""Text rules: names, ids, quotes, survey lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: every character that counts as white space when ids are trimmed (tabs, line breaks,
# separators and no-break spaces included), as a regular-expression class body.
_SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The same characters as text, for trimming without a regular expression.
_SPACES = "".join(chr(n) for n in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
    0x3000))


def strip(c: Column) -> Column:
    """Drop white space of every kind at both ends."""
    return F.btrim(c, F.lit(_SPACES))


def upper_name(c: Column) -> Column:
    """Upper-case name; NULL stays NULL."""
    return F.upper(c)


def drop_nbsp(c: Column) -> Column:
    r"""Upper-case and drop no-break spaces, real ones and those left as the text ``\XA0``."""
    return F.replace(F.replace(F.upper(c), F.lit("\\XA0"), F.lit("")), F.lit("\u00a0"), F.lit(""))


def ascii_only(c: Column) -> Column:
    """Drop all non-ASCII characters and inner blanks from an id."""
    return F.replace(F.regexp_replace(c, r"[^\x00-\x7F]+", ""), F.lit(" "), F.lit(""))


def _has_apostrophe(columns: list[str]) -> Column:
    tests = [F.coalesce(F.col(f"`{c}`").contains("'"), F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, tests)


def quotes_to_backtick(c: Column) -> Column:
    """``'`` becomes a backtick, ``"`` becomes ``'``."""
    return F.translate(c, "'\"", "`'")


def quotes_dropped(c: Column) -> Column:
    """``'`` is dropped, ``"`` becomes ``'``."""
    return F.translate(c, "\"'", "'")


def sanitise_rows(df: DataFrame, rule, columns: list[str] | None = None) -> DataFrame:
    """Apply a quote rule to all text columns of those rows that hold an apostrophe anywhere."""
    text = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumn("_dirty", _has_apostrophe(text)).select(*[
        F.when(F.col("_dirty"), rule(F.col(f"`{c}`"))).otherwise(F.col(f"`{c}`")).alias(c)
        if c in text else F.col(f"`{c}`")
        for c in df.columns
    ])


def first_integer(c: Column, default: str = "NoResponse") -> Column:
    """First whole number in a bracketed list kept as text, e.g. ``[a, 3, 4]`` → ``3``."""
    items = F.split(F.btrim(c, F.lit("[]")), ",", -1)
    numbers = F.filter(items, lambda e: e.rlike(rf"^[{_SPACE}]*[+-]?[0-9]+(_[0-9]+)*[{_SPACE}]*$"))
    return F.coalesce(F.replace(F.get(numbers, F.lit(0)), F.lit(" "), F.lit("")), F.lit(default))


def rating_number(c: Column) -> Column:
    """Survey rating text → integer, NULL for no response."""
    return c.try_cast("int")


def expected_rows(message: Column) -> Column:
    """First all-digit word of an envelope message: the row count the sender declares."""
    words = F.split(message, rf"[{_SPACE}]+")
    digits = F.filter(words, lambda w: w.rlike("^[0-9]+$"))
    return F.get(digits, F.lit(0)).try_cast("bigint")


def blank_to_null(c: Column) -> Column:
    """Empty or white-space text → NULL, so that it never acts as a join or window key."""
    return F.when(strip(c.cast("string")) != "", c)
