"""Small helpers for Arrow functions: rows in bounded pieces, and record batches from columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa

#: Rows turned into Python objects at a time.
PIECE = 256


def pieces(batches: Iterable[pa.RecordBatch], rows: int = PIECE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Key and rows of each group of rows that follow each other with the same first ``keys`` columns."""
    key, held = None, []
    for piece in pieces(batches):
        for row in zip(*(c.to_pylist() for c in piece.columns)):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held
