"""Comparison of whole records, null equal to null throughout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import FINGERPRINT_FIELDS, STAT_FIELDS, THRESHOLDS


def fingerprint(source: str | None = None) -> Column:
    """The identifying fields as one struct.

    Structs compare field by field with null equal to null, both as a grouping
    key and as a join key, so no hash and no ``<=>`` is needed.
    """
    return F.struct(*[_of(source, field).alias(field) for field in FINGERPRINT_FIELDS])


def changed_fields(old: str, new: str, fields: list[str]) -> Column:
    """Array of ``(field, old, new)`` for the fields that differ."""
    pairs = F.array(*[
        F.struct(
            F.lit(field).alias("field"),
            F.col(f"{old}.{field}").cast("string").alias("old"),
            F.col(f"{new}.{field}").cast("string").alias("new"),
        )
        for field in fields
    ])
    return F.filter(pairs, lambda pair: ~pair["old"].eqNullSafe(pair["new"]))


def any_change(old: str, new: str, fields: list[str]) -> Column:
    """Whether anything differs: cheaper than building the list of changes."""
    differs = F.lit(False)
    for field in fields:
        differs = differs | ~F.col(f"{old}.{field}").eqNullSafe(F.col(f"{new}.{field}"))
    return differs


_SEPARATOR, _ESCAPE = "\u001f", "\u001b"
_NULL = _ESCAPE + "2"


def packed(fields: list[str]) -> Column:
    """The fields as one text: a record of many fields takes far fewer bytes in a shuffle that way.

    Nothing is lost: null has a mark of its own, and a separator inside of a text is escaped.  Two records are equal when
    their texts are, null equal to null.
    """
    escaped = F.transform(F.array(*[F.col(field).cast("string") for field in fields]), lambda text: F.replace(
        F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")), F.lit(_SEPARATOR), F.lit(_ESCAPE + "1")))
    return F.array_join(escaped, _SEPARATOR, _NULL)


def parts(text: str) -> Column:
    """The texts a packed record consists of, to be taken apart once: in a column of its own."""
    return F.transform(F.split(F.col(text), _SEPARATOR, -1), lambda part: F.when(part != _NULL, F.replace(
        F.replace(part, F.lit(_ESCAPE + "1"), F.lit(_SEPARATOR)), F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))))


def unpacked(parts: str, fields: list[str], kinds: dict[str, str]) -> dict[str, Column]:
    """The fields out of the parts of packed records."""
    return {field: F.col(parts)[place].cast(kinds[field]).alias(field) for place, field in enumerate(fields)}


def review_summary(source: str | None = None) -> Column:
    """What a reviewer needs to see of an entity."""
    thresholds = F.struct(*[_of(source, f"thr_{e}").alias(e) for e in THRESHOLDS])
    plain = ["name", "rules_text", "type", *STAT_FIELDS]
    return F.struct(*[_of(source, f).alias(f) for f in plain], thresholds.alias("thresholds"))


def _of(source: str | None, field: str) -> Column:
    return F.col(f"{source}.{field}" if source else field)
