"""Field lists and schemas of the registry tables."""

from __future__ import annotations

from pyspark.sql import types as T

# The schema version and the field names of the published records.
SCHEMA_VERSION = 6

STAT_FIELDS = ["cost", "attack", "defence", "life"]
THRESHOLDS = ["air", "earth", "fire", "water"]
THRESHOLD_FIELDS = [f"thr_{element}" for element in THRESHOLDS]
INT_FIELDS = STAT_FIELDS + THRESHOLD_FIELDS

ENTITY_FIELDS = ["name", "type", "rarity", "subtypes", "elements", *INT_FIELDS, "rules_text"]

VARIANT_FIELDS = [
    "set_name", "released_at", "set_number", "product", "finish", "slug",
    "artist", "flavour_text", "type_text", "rarity", "type", "rules_text",
    *INT_FIELDS, "image_hash",
]

# Compared for attribute changes.  The image hash belongs to the state and is
# never taken from a snapshot.
ENTITY_COMPARED = [f for f in ENTITY_FIELDS if f != "name"]
VARIANT_COMPARED = [f for f in VARIANT_FIELDS if f not in ("slug", "image_hash")]

# What makes two entities "the same thing under another name".
FINGERPRINT_FIELDS = [f for f in ENTITY_COMPARED if f not in ("rarity", "subtypes")]

# Within one entity, what must agree for a variant's key change to be a rename.
PAIR_FIELDS = ["set_name", "product", "finish"]


def _field(name: str) -> T.StructField:
    return T.StructField(name, T.IntegerType() if name in INT_FIELDS else T.StringType())


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()

STATE_ENTITIES = T.StructType([T.StructField("entity_id", _L), *map(_field, ENTITY_FIELDS)])
STATE_VARIANTS = T.StructType([
    T.StructField("variant_id", _L), T.StructField("entity_id", _L),
    *map(_field, VARIANT_FIELDS), T.StructField("retired_at", _S),
])
KEY_HISTORY = _struct(("slug", _S), ("variant_id", _L), ("valid_from", _S), ("valid_to", _S))
NAME_HISTORY = _struct(("name", _S), ("entity_id", _L), ("valid_from", _S), ("valid_to", _S))
COUNTERS = _struct(("name", _S), ("value", _L))

SNAPSHOT_ENTITIES = T.StructType([T.StructField("entity_pos", _L), *map(_field, ENTITY_FIELDS)])
SNAPSHOT_VARIANTS = T.StructType([
    T.StructField("entity_pos", _L), T.StructField("set_pos", _L), T.StructField("variant_pos", _L),
    T.StructField("entity_name", _S), *map(_field, VARIANT_FIELDS),
])

STATE_TABLES = {
    "entities": STATE_ENTITIES,
    "variants": STATE_VARIANTS,
    "key_history": KEY_HISTORY,
    "name_history": NAME_HISTORY,
    "counters": COUNTERS,
}

# The field names of the nested upstream feed.
_METADATA = _struct(
    ("rarity", _S), ("type", _S), ("rulesText", _S),
    ("cost", _I), ("attack", _I), ("defence", _I), ("life", _I),
    ("thresholds", _struct(("air", _I), ("earth", _I), ("fire", _I), ("water", _I))),
)
_VARIANT = _struct(
    ("slug", _S), ("finish", _S), ("product", _S),
    ("artist", _S), ("flavorText", _S), ("typeText", _S),
)
_SET = _struct(
    ("name", _S), ("releasedAt", _S), ("metadata", _METADATA), ("variants", T.ArrayType(_VARIANT)),
)
PAYLOAD = _struct(
    ("name", _S), ("guardian", _METADATA), ("elements", _S), ("subTypes", _S),
    ("sets", T.ArrayType(_SET)),
)

# Reviewed answers to quarantined cases.
DECISIONS = {
    "entity_renames": _struct(("entity_id", _L), ("new_name", _S)),
    "new_entities": _struct(("name", _S)),
    "variant_renames": _struct(("variant_id", _L), ("new_slug", _S)),
    "new_variants": _struct(("slug", _S)),
    "retire_variants": _struct(("variant_id", _L)),
}

# One row per corrected column: a null value is a correction too.
CORRECTIONS = _struct(
    ("ord", _L), ("name", _S), ("set_name", _S), ("field", _S), ("value", _S), ("reason", _S),
)
