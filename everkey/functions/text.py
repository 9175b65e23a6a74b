"""Text clean-up and the predicates used by searches."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Code points below U+0300 are unchanged by NFC.
_BEYOND_LATIN = r"[^\x{0}-\x{2FF}]"

# White space is what Unicode says, and the four separators.
_SPACE = r"\s\x1c-\x1f"
_BLANK = rf"[{_SPACE}&&[^\n]]"

# Found in any text that is not clean yet.
_UNCLEAN = rf"(?U)\r|[{_SPACE}](?=\n|\z)|\A[{_SPACE}]"

ERRATA_PREFIX = "UPDATED"

# Fixed value: the white space that goes from both ends of ids, sets and products.
STRIPPED = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
            "\u2028\u2029\u202f\u205f\u3000")


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(STRIPPED))


def nfc(text: Column) -> Column:
    """Unicode NFC by the ICU library Spark brings along, so no row leaves the JVM."""
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return F.when(text.rlike(_BEYOND_LATIN), composed).otherwise(text)


def canon_text(text: Column) -> Column:
    """NFC, ``\\n`` line ends, no trailing blanks, no blank lines; null stays null.

    Most text is clean, and one look tells.  The look-behinds keep long runs of
    blanks linear.
    """
    composed = nfc(text)
    clean = F.regexp_replace(composed, r"\r\n?", "\n")
    clean = F.regexp_replace(clean, rf"(?U)(?<!{_BLANK}){_BLANK}++(?=\n|\z)", "")
    clean = F.regexp_replace(clean, rf"(?U)\A[{_SPACE}]++|(?<![{_SPACE}])[{_SPACE}]++\z", "")
    clean = F.regexp_replace(clean, r"\n+", "\n")
    return F.when(text.rlike(_UNCLEAN), clean).otherwise(composed)


def date_part(stamp: Column) -> Column:
    """The first ten characters of a timestamp text."""
    return F.left(stamp, F.lit(10))


def is_errata(rules_text: Column) -> Column:
    return F.coalesce(F.startswith(rules_text, F.lit(ERRATA_PREFIX)), F.lit(False))


def has_text(column: Column, wanted: str | Column) -> Column:
    """Literal, case-insensitive substring test; null holds nothing."""
    return F.contains(F.lower(F.coalesce(column, F.lit(""))), F.lower(_lit(wanted)))


def same_text(column: Column, wanted: str | Column) -> Column:
    return F.lower(F.coalesce(column, F.lit(""))) == F.lower(_lit(wanted))


def product_code(column: str | Column) -> Column:
    return F.replace(F.lower(stripped(F.coalesce(_lit(column), F.lit("")))), F.lit(" "), F.lit("_"))


def same_product(column: Column, wanted: str | Column) -> Column:
    return product_code(column) == product_code(wanted)


def is_set_number(wanted: Column) -> Column:
    return stripped(wanted).rlike("^[0-9]+$")


def set_number_of(wanted: Column) -> Column:
    """A wanted set spelled in digits, padded to three; null when it is a name."""
    text = stripped(wanted)
    padded = F.when(F.length(text) < 3, F.lpad(text, 3, "0")).otherwise(text)
    return F.when(is_set_number(wanted), padded)


def set_name_of(wanted: Column) -> Column:
    """A wanted set spelled as a name, lower-cased; null when it is a number."""
    return F.when(~is_set_number(wanted), F.lower(stripped(wanted)))


def in_wanted_set(set_number: Column, set_name: Column, wanted: str | int) -> Column:
    """The filter for one wanted set.  A number gives a bare equality, which scans can use to skip rows."""
    text = str(wanted).strip()
    if text.isdecimal() and text.isascii():
        return set_number == F.lit(text.zfill(3))
    return F.lower(F.coalesce(set_name, F.lit(""))) == F.lower(F.lit(text))


def _lit(value: str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
