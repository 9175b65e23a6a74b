"""Matroska: payloads kept as 8-bit audio in Matroska files, and files parsed to packet tables.

The parser walks EBML elements with variable-length ids and sizes, unknown sizes included, through segments, clusters,
block groups and the three kinds of lacing, and gives a row for each packet: track, timestamp, key flag and the byte
range in the file.  Cues give the byte position of a cluster for a time.  A damaged or cut-off file gives the packets
before the damage and says where it is.

A file is a value in a row, at most 2 GB; it is made and parsed where its row is, and never moves to another task.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .batches import batch, pieces
from .shipping import ship

#: Fixed values of the format: element ids.
EBML, SEGMENT, VOID, CRC = 0x1A45DFA3, 0x18538067, 0xEC, 0xBF
SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES, TAGS, CHAPTERS, ATTACHMENTS = 0x114D9B74, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B, 0x1254C367, 0x1043A770, 0x1941A469
TIMESTAMP_SCALE, MUXER, WRITER = 0x2AD7B1, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, LACING, DEFAULT_DURATION = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x9C, 0x23E383
AUDIO, RATE, CHANNELS, DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE, DURATION = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB, 0x9B
CUE_POINT, CUE_TIME, CUE_PLACES, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
TOP = {SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES, TAGS, CHAPTERS, ATTACHMENTS, EBML, SEGMENT}

#: One sample is one byte; a frame is this many of them, a block laces up to ``LACED`` frames, a cluster holds ``BLOCKS``.
UNIT, FRAME, LACED, BLOCKS = 64, 512, 8, 16
SAMPLE_RATE = 8000
TRACK = 1


# ---- writing


def number(value: int) -> bytes:
    return value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big")


def size(value: int, width: int = 0) -> bytes:
    """A variable-length size, the shortest that is not the mark for unknown."""
    width = width or next(n for n in range(1, 9) if value < (1 << 7 * n) - 1)
    return (value | 1 << 7 * width).to_bytes(width, "big")


def element(id: int, *body: bytes) -> bytes:
    content = b"".join(body)
    return number(id) + size(len(content)) + content


def laced(frames: list[bytes]) -> tuple[int, bytes]:
    """Lacing flag and body of a block: fixed-size lacing for equal frames, EBML lacing for others, none for one."""
    if len(frames) == 1:
        return 0, frames[0]
    head, sizes = bytes([len(frames) - 1]), [len(f) for f in frames]
    if len(set(sizes)) == 1:
        return 2, head + b"".join(frames)
    coded = size(sizes[0])
    for before, now in zip(sizes, sizes[1:-1]):
        step = now - before
        width = next(n for n in range(1, 9) if abs(step) < (1 << 7 * n - 1) - 1)
        coded += size(step + (1 << 7 * width - 1) - 1, width)
    return 3, head + coded + b"".join(frames)


def padded(payload: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of the unit."""
    return payload + bytes(-len(payload) % UNIT or (0 if payload else UNIT))


def mux(payload: bytes) -> bytes:
    """A Matroska file with the payload as 8-bit mono samples; the last frame of a file may be shorter."""
    info = element(INFO, element(TIMESTAMP_SCALE, number(1_000_000)), element(MUXER, b"everkey"), element(WRITER, b"everkey"))
    audio = element(AUDIO, element(RATE, struct.pack(">d", SAMPLE_RATE)), element(CHANNELS, number(1)), element(DEPTH, number(8)))
    track = element(TRACK_ENTRY, element(TRACK_NUMBER, number(TRACK)), element(TRACK_UID, number(TRACK)), element(TRACK_TYPE, number(2)), element(CODEC, b"A_PCM/INT/LIT"),
                    element(LACING, number(1)), element(DEFAULT_DURATION, number(FRAME * 1_000_000_000 // SAMPLE_RATE)), audio)
    parts, cues = [info, element(TRACKS, track)], []
    place, step = sum(map(len, parts)), FRAME * LACED
    for at in range(0, len(payload), step * BLOCKS):
        time, blocks = at * 1000 // SAMPLE_RATE, []
        for b in range(at, min(at + step * BLOCKS, len(payload)), step):
            frames = [payload[f: min(f + FRAME, b + step)] for f in range(b, min(b + step, len(payload)), FRAME)]
            flag, body = laced(frames)
            blocks.append(element(SIMPLE_BLOCK, size(TRACK), struct.pack(">hB", b * 1000 // SAMPLE_RATE - time, 0x80 | flag << 1), body))
        cluster = element(CLUSTER, element(TIMESTAMP, number(time)), *blocks)
        cues.append(element(CUE_POINT, element(CUE_TIME, number(time)), element(CUE_PLACES, element(CUE_TRACK, number(TRACK)), element(CUE_CLUSTER, number(place)))))
        parts.append(cluster)
        place += len(cluster)
    head = element(EBML, element(0x4286, number(1)), element(0x42F7, number(1)), element(0x42F2, number(4)), element(0x42F3, number(8)), element(0x4282, b"matroska"), element(0x4287, number(4)), element(0x4285, number(2)))
    return head + element(SEGMENT, *parts, element(CUES, *cues))


# ---- reading


class Damaged(ValueError):
    pass


@dataclass
class Packet:
    track: int
    #: Milliseconds at the usual scale; units of the segment's scale.
    timestamp: int
    key: bool
    start: int
    end: int
    #: Place in the block's lace, and byte position of the cluster.
    lace: int
    cluster: int


@dataclass
class Parsed:
    packets: list[Packet] = field(default_factory=list)
    tracks: list[tuple[int, str]] = field(default_factory=list)
    #: (time, track, byte position of the cluster in the file)
    cues: list[tuple[int, int, int]] = field(default_factory=list)
    scale: int = 1_000_000
    clusters: int = 0
    damage: str | None = None


def read_size(data: bytes, at: int, limit: int) -> tuple[int, int, bool]:
    """Value, next place, and whether all value bits are set (an unknown size)."""
    if at >= limit or not data[at]:
        raise Damaged(f"no variable-length number at {at}")
    width = 9 - data[at].bit_length()
    if at + width > limit:
        raise Damaged(f"number at {at} is cut off")
    value = int.from_bytes(data[at: at + width], "big") & (1 << 7 * width) - 1
    return value, at + width, value == (1 << 7 * width) - 1


def head(data: bytes, at: int, limit: int) -> tuple[int, int, int | None]:
    """Id, begin of body and length of the element at ``at``; the length is None if it is unknown."""
    if not data[at]:
        raise Damaged(f"no element at {at}")
    width = 9 - data[at].bit_length()
    if width > 4 or at + width > limit:
        raise Damaged(f"no element id at {at}")
    id = int.from_bytes(data[at: at + width], "big")
    length, body, unknown = read_size(data, at + width, limit)
    if unknown and id not in (SEGMENT, CLUSTER):
        raise Damaged(f"element at {at} has no size")
    return id, body, None if unknown else length


def closes(inside: int, id: int) -> bool:
    """Whether an element can't be inside a parent of unknown size, whose end it marks."""
    return inside == CLUSTER and id in TOP or inside == SEGMENT and id in (EBML, SEGMENT)


def end_of(data: bytes, at: int, limit: int, inside: int) -> int:
    """Where a parent of unknown size ends: its children are passed over one by one."""
    while at < limit:
        id, body, length = head(data, at, limit)
        if closes(inside, id):
            return at
        at = end_of(data, body, limit, id) if length is None else body + length
        if at > limit:
            raise Damaged(f"element before {at} is cut off")
    return at


def elements(data: bytes, at: int, limit: int, inside: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """(id, begin of body, end of body, id again if the size is unknown, else 0) of each element.

    One of unknown size is given with the end of its parent, before its own is looked for, so that what stands before any
    damage inside is read; walking its children with ``inside`` finds the end.  Of a segment or cluster that is cut off,
    the part at hand is given.
    """
    while at < limit:
        id, body, length = head(data, at, limit)
        if closes(inside, id):
            return
        if length is None:
            yield id, body, limit, id
            at = end_of(data, body, limit, id)
            continue
        end = body + length
        if end > limit:
            if id in (SEGMENT, CLUSTER):
                yield id, body, limit, 0
            raise Damaged(f"element at {at} is cut off")
        yield id, body, end, 0
        at = end


def whole(data: bytes, at: int, end: int) -> int:
    return int.from_bytes(data[at:end], "big")


def frame_sizes(data: bytes, at: int, end: int, flag: int) -> tuple[list[int], int]:
    """Sizes of the frames of a block's body, and where the first begins."""
    if not flag:
        return [end - at], at
    if at >= end:
        raise Damaged(f"lace at {at} is cut off")
    count, at, sizes = data[at] + 1, at + 1, []
    if flag == 1:
        for _ in range(count - 1):
            total = 0
            while True:
                if at >= end:
                    raise Damaged(f"lace at {at} is cut off")
                total, at = total + data[at], at + 1
                if data[at - 1] != 255:
                    break
            sizes.append(total)
    elif flag == 3:
        for k in range(count - 1):
            first = at
            value, at, _ = read_size(data, at, end)
            sizes.append(value if not k else sizes[-1] + value - ((1 << 7 * (at - first) - 1) - 1))
    else:
        if (end - at) % count:
            raise Damaged(f"lace at {at} does not divide")
        return [(end - at) // count] * count, at
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise Damaged(f"lace at {at} is too long")
    return sizes, at


def read_block(out: Parsed, data: bytes, at: int, end: int, base: int, cluster: int, key: bool | None) -> None:
    track, at, _ = read_size(data, at, end)
    if at + 3 > end:
        raise Damaged(f"block at {at} is cut off")
    offset, flags = struct.unpack(">hB", data[at: at + 3])
    sizes, place = frame_sizes(data, at + 3, end, flags >> 1 & 3)
    for k, length in enumerate(sizes):
        out.packets.append(Packet(track, base + offset, bool(flags & 0x80) if key is None else key, place, place + length, k, cluster))
        place += length


def parse(data: bytes) -> Parsed:
    """Packets, tracks and cues of a file, in file order.  Elements it does not know are passed over."""
    out = Parsed()
    try:
        for id, at, end, open_ in elements(data, 0, len(data)):
            if id == SEGMENT:
                _segment(out, data, at, end, open_)
    except Damaged as error:
        out.damage = str(error)
    return out


def _segment(out: Parsed, data: bytes, start: int, limit: int, inside: int) -> None:
    for id, at, end, open_ in elements(data, start, limit, inside):
        if id == INFO:
            for i, a, b, _ in elements(data, at, end):
                if i == TIMESTAMP_SCALE:
                    out.scale = whole(data, a, b)
        elif id == TRACKS:
            for i, a, b, _ in elements(data, at, end):
                if i == TRACK_ENTRY:
                    own = {j: data[x:y] for j, x, y, _ in elements(data, a, b)}
                    out.tracks.append((int.from_bytes(own.get(TRACK_NUMBER, b""), "big"), own.get(CODEC, b"").decode("ascii", "replace")))
        elif id == CUES:
            for i, a, b, _ in elements(data, at, end):
                if i == CUE_POINT:
                    time = next((whole(data, x, y) for j, x, y, _ in elements(data, a, b) if j == CUE_TIME), 0)
                    for j, x, y, _ in elements(data, a, b):
                        if j == CUE_PLACES:
                            own = {k: whole(data, p, q) for k, p, q, _ in elements(data, x, y)}
                            out.cues.append((time, own.get(CUE_TRACK, 0), start + own.get(CUE_CLUSTER, 0)))
        elif id == CLUSTER:
            out.clusters += 1
            base = 0
            for i, a, b, _ in elements(data, at, end, open_):
                if i == TIMESTAMP:
                    base = whole(data, a, b)
                elif i == SIMPLE_BLOCK:
                    read_block(out, data, a, b, base, at, None)
                elif i == BLOCK_GROUP:
                    inner = list(elements(data, a, b))
                    key = all(j != REFERENCE for j, *_ in inner)
                    for j, x, y, _ in inner:
                        if j == BLOCK:
                            read_block(out, data, x, y, base, at, key)


# ---- tables


def stored(documents: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, media``: each whole text as a Matroska file.

    Null texts count as empty; repeated rows are stored one by one, an empty table gives no rows, other columns are not
    touched.
    """
    ship(documents.sparkSession)
    schema = pa.schema([("_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 64):
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in piece.column(1).to_pylist()]
            yield batch(schema, piece.column(0), [len(r) for r in raw], [mux(padded(r)) for r in raw])

    return documents.select(F.col(id).cast("long"), F.col(text)).mapInArrow(run, "_id long, n_bytes long, media binary").withColumnRenamed("_id", id)


def packets(files: DataFrame, media: str = "media", id: str = "doc_id") -> DataFrame:
    """A row for each packet: ``doc_id, packet, track, timestamp, key, lace, cluster_at, start, end, damage``.

    Timestamps are nanoseconds.  ``start`` and ``end`` are the packet's byte range in the file.  A file without packets, a
    null one included, has one row whose packet is null; ``damage`` says where parsing stopped, on the last row.
    """
    ship(files.sparkSession)
    schema = pa.schema([("_id", pa.int64()), ("packet", pa.int64()), ("track", pa.int64()), ("timestamp", pa.int64()), ("key", pa.bool_()), ("lace", pa.int32()),
                        ("cluster_at", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("damage", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 64):
            for file_id, data in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                found = parse(data or b"")
                rows = [(file_id, i, p.track, p.timestamp * found.scale, p.key, p.lace, p.cluster, p.start, p.end, None) for i, p in enumerate(found.packets)]
                rows = rows or [(file_id, *[None] * 9)]
                rows[-1] = (*rows[-1][:-1], found.damage)
                yield batch(schema, *zip(*rows))

    kinds = "_id long, packet long, track long, timestamp long, key boolean, lace int, cluster_at long, start long, `end` long, damage string"
    return files.select(F.col(id).cast("long"), F.col(media)).mapInArrow(run, kinds).withColumnRenamed("_id", id)


def features(payload: bytes, found: Parsed) -> str:
    """What the samples look like: loudest and mean level around the middle, and how often it is crossed."""
    samples = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(((samples[1:] < 0) != (samples[:-1] < 0)).sum())
    lasts = max((p.timestamp for p in found.packets), default=0)
    return (f"tracks={len(found.tracks)};clusters={found.clusters};cues={len(found.cues)};packets={len(found.packets)};last_ms={lasts};"
            f"peak={int(np.abs(samples).max(initial=0))};level={int(np.abs(samples).sum()) // max(len(samples), 1)};crossings={crossings}")


def read_back(files: DataFrame, id: str = "doc_id") -> DataFrame:
    """``doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, damage`` from files
    as :func:`stored` gives them: the payload is put together from the packets' byte ranges.

    A null file is an empty one, without payload; of a damaged file the packets before the damage are read.  Repeated rows
    are read one by one, an empty table gives no rows, other columns are not touched.
    """
    ship(files.sparkSession)
    schema = pa.schema([("_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()),
                        ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("damage", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 64):
            rows = []
            for file_id, n, data in zip(*(c.to_pylist() for c in piece.columns)):
                data = data or b""
                found = parse(data)
                payload = b"".join(data[p.start: p.end] for p in found.packets if p.track == TRACK)
                rows.append((file_id, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest(), features(payload, found), found.damage))
            if rows:
                yield batch(schema, *zip(*rows))

    kinds = "_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, damage string"
    return files.select(F.col(id).cast("long"), "n_bytes", "media").mapInArrow(run, kinds).withColumnRenamed("_id", id)
