"""Small tables for the tests."""

from __future__ import annotations

import itertools

from everkey.operators.apply import State
from everkey.schemas import (
    COUNTERS, DECISIONS, ENTITY_FIELDS, INT_FIELDS, KEY_HISTORY, NAME_HISTORY, PAYLOAD, SNAPSHOT_ENTITIES,
    SNAPSHOT_VARIANTS, STATE_ENTITIES, STATE_VARIANTS, VARIANT_FIELDS,
)
from pyspark.sql import types as T

DAY0, DAY1, DAY2 = "2025-01-01", "2025-02-01", "2025-03-01"


def entity(name, **fields):
    record = {f: (0 if f.startswith("thr_") else None) for f in ENTITY_FIELDS}
    return record | {"type": "Beast", "rarity": "Common", "cost": 3, "rules_text": f"Text of {name}"} \
        | {"name": name} | fields


def variant(slug, of, **fields):
    record = {f: (0 if f.startswith("thr_") else None) for f in VARIANT_FIELDS}
    return record | {"slug": slug, "set_name": "First", "set_number": slug[:3], "product": "Box",
                     "finish": "Plain", "released_at": "2024-05-05", "entity_name": of} | fields


def frame(spark, rows, schema):
    assert not {k for row in rows for k in row} - set(schema.names) - {"entity_name"}
    return spark.createDataFrame([tuple(row.get(f) for f in schema.names) for row in rows], schema)


def state(spark, entities, variants, history=(), names=()):
    """Ids by position; history rows are added to one open row per record."""
    ids = {}
    entity_rows, variant_rows = [], []
    for number, row in enumerate(entities, 1):
        ids[row["name"]] = number
        entity_rows.append({"entity_id": number, **row})
    for number, row in enumerate(variants, 1):
        variant_rows.append({"variant_id": number, "entity_id": ids[row["entity_name"]], **row})
    keys = [(r["slug"], r["variant_id"], DAY0, None) for r in variant_rows] + list(history)
    called = [(r["name"], r["entity_id"], DAY0, None) for r in entity_rows] + list(names)
    return State(
        entities=frame(spark, entity_rows, STATE_ENTITIES),
        variants=frame(spark, variant_rows, STATE_VARIANTS),
        key_history=spark.createDataFrame(keys, KEY_HISTORY),
        name_history=spark.createDataFrame(called, NAME_HISTORY),
        counters=spark.createDataFrame(
            [("schema_version", 6), ("next_entity_id", len(entity_rows) + 1),
             ("next_variant_id", len(variant_rows) + 1)], COUNTERS),
    )


def snapshot(spark, entities, variants):
    positions = itertools.count()
    return (
        frame(spark, [{"entity_pos": i, **row} for i, row in enumerate(entities)], SNAPSHOT_ENTITIES),
        frame(spark, [{"entity_pos": 0, "set_pos": 0, "variant_pos": next(positions), **row} for row in variants],
              SNAPSHOT_VARIANTS),
    )


def decisions(spark, **lists):
    assert not set(lists) - set(DECISIONS)
    return {name: spark.createDataFrame(lists.get(name, []), schema) for name, schema in DECISIONS.items()}


def metadata(**fields):
    return {"rarity": "Common", "type": "Beast", "rulesText": "Text", "cost": 3, "thresholds": None} | fields


def payload(spark, entries):
    schema = T.StructType([T.StructField("entity_pos", T.LongType()), *PAYLOAD.fields])

    def shape(value, kind):
        if isinstance(kind, T.StructType) and value is not None:
            return {f.name: shape(value.get(f.name), f.dataType) for f in kind.fields}
        if isinstance(kind, T.ArrayType) and value is not None:
            return [shape(v, kind.elementType) for v in value]
        return value

    return spark.createDataFrame([shape({"entity_pos": i, **e}, schema) for i, e in enumerate(entries)], schema)


def entry(name, sets, **fields):
    return {"name": name, "guardian": metadata(rulesText=f"Text of {name}"), "sets": sets} | fields


def card_set(name, *variants, **fields):
    return {"name": name, "releasedAt": "2024-05-05T10:00:00Z", "metadata": metadata(), "variants": list(variants)} | fields


def piece(slug, product="Box", finish="Plain", **fields):
    return {"slug": slug, "product": product, "finish": finish} | fields


def rows(df, *columns):
    """Result rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
