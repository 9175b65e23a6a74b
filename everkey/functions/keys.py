"""Natural keys and published ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import stripped

# The shape of a variant key (set number, name, product, finish)
# and of a published id.
KEY_PATTERN = r"(?d)^(\p{Nd}+)-(.+)-([a-z_]+)-([a-z]+)$"
KEY_PARTS = ["set_number", "name_part", "product_code", "finish_code"]
ENTITY_PREFIX = "C"
VARIANT_PREFIX = "P"
ID_FORMAT = "%06d"
ID_PATTERN = r"^[CcPp]?([0-9]+)$"


def key_part(slug: Column, part: str) -> Column:
    """One part of a key, null when the key does not have the known shape."""
    found = F.regexp_extract(slug, KEY_PATTERN, KEY_PARTS.index(part) + 1)
    return F.nullif(found, F.lit(""))


def _published(prefix: str, number: Column) -> Column:
    # format_string keeps ids of more than six digits whole; lpad would cut them.
    return F.when(number.isNotNull(), F.format_string(prefix + ID_FORMAT, number.cast("bigint")))


def entity_ref(number: Column) -> Column:
    return _published(ENTITY_PREFIX, number)


def variant_ref(number: Column) -> Column:
    return _published(VARIANT_PREFIX, number)


def id_number(spelling: Column) -> Column:
    """The integer in any spelling of an id, blanks around it or not; null when it is not one."""
    return F.nullif(F.regexp_extract(stripped(spelling.cast("string")), ID_PATTERN, 1), F.lit("")).try_cast("bigint")


def normal_entity_ref(spelling: Column) -> Column:
    return entity_ref(id_number(spelling))


def normal_variant_ref(spelling: Column) -> Column:
    return variant_ref(id_number(spelling))
