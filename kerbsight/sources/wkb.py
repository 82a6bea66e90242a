"""WKB geometry columns at the table borders, decoded and encoded in Arrow batches."""

from __future__ import annotations

import struct
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from kerbsight import schemas

# ship the helpers below with the job; workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Geometry type codes of the WKB format.
LINE, POLYGON, MULTI_LINE, MULTI_POLYGON = 2, 3, 5, 6
_EWKB_SRID = 0x20000000
ARROW_GEOM = to_arrow_type(schemas.GEOM)


def _header(data: bytes, at: int) -> tuple[str, int, int, int]:
    """Byte order, geometry type, coordinates per vertex and position after the header."""
    order = "<" if data[at] == 1 else ">"
    code = struct.unpack_from(order + "I", data, at + 1)[0]
    at += 9 if code & _EWKB_SRID else 5
    kind, family = code & 0xFF if code & 0xE0000000 else code % 1000, code // 1000 % 10
    width = 2 + bool(code & 0x80000000 or family in (1, 3)) + bool(code & 0x40000000 or family in (2, 3))
    return order, kind, width, at


def _vertices(data: bytes, order: str, width: int, at: int) -> tuple[list[dict], int]:
    n = struct.unpack_from(order + "I", data, at)[0]
    flat = np.frombuffer(data, dtype=order + "f8", count=n * width, offset=at + 4).reshape(n, width)
    return [{"x": float(x), "y": float(y)} for x, y in flat[:, :2]], at + 4 + n * width * 8


def decode(data: bytes | None) -> list[list[dict]] | None:
    """Parts of a line, or outer rings (without the closing vertex) of a polygon."""
    if data is None:
        return None
    parts: list[list[dict]] = []

    def read(at: int) -> int:
        order, kind, width, at = _header(data, at)
        if kind == LINE:
            part, at = _vertices(data, order, width, at)
            if part:
                parts.append(part)
            return at
        count = struct.unpack_from(order + "I", data, at)[0]
        at += 4
        if kind == POLYGON:
            for ring in range(count):
                vertices, at = _vertices(data, order, width, at)
                if ring:
                    raise ValueError("polygons with holes are not sight areas")
                parts.append(vertices[:-1])
            return at
        if kind in (MULTI_LINE, MULTI_POLYGON):
            for _ in range(count):
                at = read(at)
            return at
        raise ValueError(f"geometry type {kind} is not a line or a polygon")

    read(0)
    return parts


def encode(parts: list | np.ndarray | None, polygon: bool) -> bytes | None:
    """One part gives a simple geometry, several a multi geometry (little endian)."""
    if parts is None:
        return None

    def one(part) -> bytes:
        xy = [(v["x"], v["y"]) for v in part]
        if polygon:
            xy.append(xy[0])
        body = struct.pack("<I", len(xy)) + np.asarray(xy, dtype="<f8").tobytes()
        return struct.pack("<BI", 1, POLYGON if polygon else LINE) + (struct.pack("<I", 1) if polygon else b"") + body

    if len(parts) == 1:
        return one(parts[0])
    head = struct.pack("<BII", 1, MULTI_POLYGON if polygon else MULTI_LINE, len(parts))
    return head + b"".join(one(p) for p in parts)


def encode_column(geoms: pa.ListArray, polygon: bool) -> pa.Array:
    """:func:`encode` of a whole column at once: coordinates and headers go to their places in one buffer."""
    known = geoms.is_valid().to_numpy(zero_copy_only=False)
    parts = geoms.flatten()
    vertices = parts.flatten()
    if parts.null_count or vertices.null_count:
        raise ValueError("a geometry has a missing part or vertex")
    n_parts = np.where(known, geoms.value_lengths().to_numpy(zero_copy_only=False), 0).astype(np.int64)
    n_vertices = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if polygon and (n_vertices == 0).any():
        raise ValueError("a ring has no vertex")
    x, y = (vertices.field(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in ("x", "y"))
    xy = np.stack([x, y], axis=1).astype("<f8").reshape(-1, 2)
    first = np.cumsum(n_vertices) - n_vertices
    if polygon:  # the first vertex closes its ring
        of = np.repeat(np.arange(len(n_vertices)), n_vertices + 1)
        at = np.arange(len(of)) - np.repeat(first + np.arange(len(n_vertices)), n_vertices + 1)
        xy = xy[first[of] + at % n_vertices[of]]
        n_vertices = n_vertices + 1
    head = 13 if polygon else 9
    multi = known & (n_parts != 1)
    part_size = head + 16 * n_vertices
    part_of = np.repeat(np.arange(len(n_parts)), n_parts)
    sizes = np.bincount(part_of, part_size, minlength=len(n_parts)).astype(np.int64) + 9 * multi
    ends = np.cumsum(sizes)
    starts = ends - sizes
    part_first = np.cumsum(n_parts) - n_parts  # place of a geometry's first part
    before = np.cumsum(part_size) - part_size
    part_start = starts[part_of] + 9 * multi[part_of] + before - before[part_first[part_of]]
    data = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)

    def put(places: np.ndarray, values: np.ndarray) -> None:
        if not len(places):
            return
        raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(places), -1)
        data[places[:, None] + np.arange(raw.shape[1])] = raw

    def number(places: np.ndarray, values: np.ndarray | int) -> None:
        put(places, np.broadcast_to(np.asarray(values, dtype="<u4"), places.shape))

    groups = starts[multi]
    data[groups] = data[part_start] = 1
    number(groups + 1, MULTI_POLYGON if polygon else MULTI_LINE)
    number(groups + 5, n_parts[multi])
    number(part_start + 1, POLYGON if polygon else LINE)
    if polygon:
        number(part_start + 5, 1)
    number(part_start + head - 4, n_vertices)
    inside = np.arange(len(xy)) - np.repeat(np.cumsum(n_vertices) - n_vertices, n_vertices)
    put(np.repeat(part_start + head, n_vertices) + 16 * inside, xy)
    offsets = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64))
    out = pa.Array.from_buffers(pa.large_binary(), len(n_parts), [None, offsets, pa.py_buffer(data)])
    return pc.if_else(pa.array(known), out, pa.scalar(None, pa.large_binary())).cast(pa.binary())


def decode_column(wkb: pa.Array) -> pa.Array:
    """:func:`decode` of a whole column: lines and single rings of two coordinates at once, other geometries one by one."""
    whole = wkb.cast(pa.large_binary())
    _, offsets, raw = whole.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[whole.offset:whole.offset + len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    starts, sizes = offsets[:-1], np.diff(offsets)
    known = whole.is_valid().to_numpy(zero_copy_only=False)

    def number(rows: np.ndarray, at: int) -> np.ndarray:
        return np.ascontiguousarray(data[(starts[rows] + at)[:, None] + np.arange(4)]).view("<u4").ravel().astype(np.int64)

    plain = np.zeros(len(sizes), dtype=bool)
    head, n = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for kind, size in ((LINE, 9), (POLYGON, 13)):
        rows = np.flatnonzero(known & (sizes >= size + 16))
        rows = rows[(data[starts[rows]] == 1)]
        rows = rows[number(rows, 1) == kind]
        if kind == POLYGON:
            rows = rows[number(rows, 5) == 1]
        count = number(rows, size - 4)
        fits = sizes[rows] == size + 16 * count
        rows, count = rows[fits], count[fits]
        plain[rows], head[rows], n[rows] = True, size, count
    quick = np.flatnonzero(plain)
    kept = n[quick] - (head[quick] == 13)  # without the closing vertex
    ends = np.cumsum(kept)
    inside = np.arange(int(kept.sum())) - np.repeat(ends - kept, kept)
    places = np.repeat(starts[quick] + head[quick], kept) + 16 * inside
    xy = np.ascontiguousarray(data[places[:, None] + np.arange(16)]).view("<f8").reshape(-1, 2)
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"])
    lines = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), points)
    simple = pa.ListArray.from_arrays(pa.array(np.arange(len(quick) + 1), pa.int32()), lines).cast(ARROW_GEOM)
    slow = np.flatnonzero(~plain)
    if not len(slow):
        return simple
    others = pa.array([decode(whole[int(i)].as_py()) for i in slow], ARROW_GEOM)
    return pa.concat_arrays([simple, others]).take(pa.array(np.argsort(np.concatenate([quick, slow]), kind="stable")))


def _replaced(df: DataFrame, column: str, name: str, kind: T.DataType, change: Callable[[pa.Array], pa.Array]) -> DataFrame:
    out = T.StructType([f for f in df.schema.fields if f.name != column] + [T.StructField(name, kind)])

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            rest = [n for n in frame.schema.names if n != column]
            yield pa.RecordBatch.from_arrays([*(frame.column(n) for n in rest), change(frame.column(column))], [*rest, name])

    return df.mapInArrow(batches, out)


def from_wkb(df: DataFrame, column: str = "geometry", name: str = "geom") -> DataFrame:
    """Replace a WKB column by nested vertex arrays."""
    return _replaced(df, column, name, schemas.GEOM, decode_column)


def to_wkb(df: DataFrame, column: str = "geom", name: str = "geometry", polygon: bool = False) -> DataFrame:
    """Replace nested vertex arrays by a WKB column."""
    return _replaced(df, column, name, T.BinaryType(), lambda geoms: encode_column(geoms, polygon))


def drop_empty(df: DataFrame, column: str = "geom") -> DataFrame:
    """Rows with at least one part that has a vertex."""
    return df.filter(F.exists(column, lambda part: F.size(part) > 0))
