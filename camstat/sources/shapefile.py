"""Shapefiles (S7): polygons, lines and points with their attributes, read by record ranges.

The index file (.shx) says where every record of the geometry file (.shp) starts, and records of the attribute file (.dbf)
have one length, so ranges of records are dealt over all tasks and each task reads only its own bytes.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from camstat.functions.projection import LambertConic, TransverseMercator
from camstat.sources.fileio import open_input, write_bytes

#: Records that one row of the range table stands for.
RANGE = 256
#: Vertices handed on at once when records are read.
VERTEX_ROWS = 65_536
VERTICES = "path string, record long, ring int, seq int, x double, y double"


def _beside(path: str, ending: str) -> str:
    return path[:-4] + (ending.upper() if path.endswith(".SHP") else ending)


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{shp,SHP}").load(path).select("path"))

    def cut(batches):
        import pandas as pd

        for batch in batches:
            for p in batch["path"]:
                with open_input(_beside(p, ".shx")) as f:
                    n = (f.size() - 100) // 8
                first = np.arange(0, n, RANGE)
                yield pd.DataFrame({"path": p, "first": first, "n": np.minimum(RANGE, n - first)})

    found = files.mapInPandas(cut, "path string, first long, n long")
    return found.repartition(max(spark.sparkContext.defaultParallelism, -(-found.count() // 16)), "path", "first")


def parse_shape(data: bytes) -> list[np.ndarray]:
    """The parts of a record's content as arrays of (x, y); a null shape has none."""
    kind = struct.unpack("<i", data[:4])[0]
    if kind == 0:
        return []
    if kind in (1, 11, 21):  # a point, with or without z and m
        return [np.frombuffer(data, "<f8", 2, 4).reshape(1, 2)]
    if kind in (8, 18, 28):
        n = struct.unpack("<i", data[36:40])[0]
        return [np.frombuffer(data, "<f8", 2 * n, 40).reshape(n, 2)]
    if kind in (3, 5, 13, 15, 23, 25):
        parts, n = struct.unpack("<ii", data[36:44])
        starts = [*struct.unpack(f"<{parts}i", data[44:44 + 4 * parts]), n]
        xy = np.frombuffer(data, "<f8", 2 * n, 44 + 4 * parts).reshape(n, 2)
        return [xy[a:b] for a, b in zip(starts, starts[1:])]
    raise ValueError(f"shapes of kind {kind} are not read")


def read_shapes(spark: SparkSession, path: str, projection: TransverseMercator | LambertConic | None = None) -> DataFrame:
    """Vertex rows (path, record from 0, ring, seq, x, y) of all shapefiles under ``path``.  A ring's closing vertex, which
    repeats its first one, is left out.  ``projection``: the files' coordinates are turned into longitude and latitude."""

    def vertices(p, records, rings, parts):
        import pandas as pd

        sizes, xy = [len(v) for v in parts], np.concatenate(parts)
        ends = np.cumsum(sizes)
        return pd.DataFrame({"path": p, "record": np.repeat(records, sizes), "ring": np.repeat(rings, sizes),
                             "seq": np.arange(len(xy)) - np.repeat(ends - sizes, sizes), "x": xy[:, 0], "y": xy[:, 1]})

    def read(batches):
        for batch in batches:
            for p, first, n in zip(batch["path"], batch["first"], batch["n"]):
                with open_input(_beside(p, ".shx")) as f:
                    f.seek(100 + 8 * int(first))
                    places = np.frombuffer(f.read(8 * int(n)), ">i4").reshape(-1, 2) * 2
                records, rings, parts, held = [], [], [], 0
                with open_input(p) as f:
                    for k, (offset, size) in enumerate(places):
                        f.seek(int(offset) + 8)
                        for ring, xy in enumerate(parse_shape(f.read(int(size)))):
                            if len(xy) > 1 and xy[0, 0] == xy[-1, 0] and xy[0, 1] == xy[-1, 1]:
                                xy = xy[:-1]
                            records.append(int(first) + k)
                            rings.append(ring)
                            parts.append(xy)
                            held += len(xy)
                            if held >= VERTEX_ROWS:
                                yield vertices(p, records, rings, parts)
                                records, rings, parts, held = [], [], [], 0
                if parts:
                    yield vertices(p, records, rings, parts)

    out = _ranges(spark, path).mapInPandas(read, VERTICES)
    if projection is not None:
        x, y = projection.inverse(F.col("x"), F.col("y"))
        out = out.withColumns({"x": x, "y": y})
    return out


def _fields(f) -> tuple[int, int, int, list[tuple[str, str, int, int]]]:
    """(records, header bytes, record bytes, fields: name, kind, length, decimals) of an open attribute file."""
    n, head, size = struct.unpack("<xxxxIHH", f.read(12))
    f.seek(32)
    raw = f.read(head - 32)
    fields = []
    for at in range(0, len(raw) - 31, 32):
        if raw[at] == 0x0D:
            break
        name, kind, length, decimals = struct.unpack("<11sc4xBB", raw[at:at + 18])
        fields.append((name.split(b"\0")[0].decode("latin-1"), kind.decode(), length, decimals))
    return n, head, size, fields


def _value(text: str, kind: str):
    text = text.strip()
    if not text or set(text) == {"*"}:
        return None
    if kind in "NF":
        return float(text)
    if kind == "L":
        return {"T": True, "Y": True, "F": False, "N": False}.get(text.upper())
    return text


def read_attributes(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """One row per record (path, record, the attributes) of all shapefiles under ``path``: numbers as doubles, dates as
    dates, flags as booleans, the rest as trimmed text; blank values are null.  The files must share one set of fields."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{shp,SHP}").load(path).select("path"))

    def kinds(batches):
        import pandas as pd

        for batch in batches:
            for p in batch["path"]:
                with open_input(_beside(p, ".dbf")) as f:
                    yield pd.DataFrame({"fields": ["\n".join(f"{n}\t{k}" for n, k, _, _ in _fields(f)[3])]})

    found = [r["fields"] for r in files.mapInPandas(kinds, "fields string").distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError("the files differ in their fields")
    fields = [line.split("\t") for line in found[0].split("\n")] if found and found[0] else []
    of = {"N": "double", "F": "double", "L": "boolean"}
    schema = ", ".join(["path string", "record long", *[f"`{n}` {of.get(k, 'string')}" for n, k in fields]])

    def read(batches):
        import pandas as pd

        for batch in batches:
            for p, first, n in zip(batch["path"], batch["first"], batch["n"]):
                with open_input(_beside(p, ".dbf")) as f:
                    _, head, size, own = _fields(f)
                    f.seek(head + int(first) * size)
                    data = f.read(int(n) * size)
                rows = []
                for k in range(len(data) // size):
                    at, row = k * size + 1, [p, int(first) + k]
                    for _, kind, length, _ in own:
                        row.append(_value(data[at:at + length].decode(encoding, "replace"), kind))
                        at += length
                    rows.append(row)
                yield pd.DataFrame(rows, columns=["path", "record", *[n for n, *_ in own]])

    out = _ranges(spark, path).mapInPandas(read, schema)
    return out.withColumns({n: F.to_date(f"`{n}`", "yyyyMMdd") for n, k in fields if k == "D"})


def encode_shapes(shapes: list[list[np.ndarray]]) -> tuple[bytes, bytes]:
    """(.shp, .shx) of polygons, each a list of closed rings."""
    records, index, at = [], [], 100
    every = np.vstack([r for s in shapes for r in s]) if any(shapes) else np.zeros((1, 2))
    for k, rings in enumerate(shapes):
        if rings:
            xy = rings[0] if len(rings) == 1 else np.vstack(rings)
            starts = np.cumsum([0] + [len(r) for r in rings[:-1]]).astype("<i4")
            body = struct.pack("<i4dii", 5, *xy.min(axis=0), *xy.max(axis=0), len(rings), len(xy)) + starts.tobytes() + xy.astype("<f8").tobytes()
        else:
            body = struct.pack("<i", 0)
        records.append(struct.pack(">ii", k + 1, len(body) // 2) + body)
        index.append(struct.pack(">ii", at // 2, len(body) // 2))
        at += len(body) + 8

    def head(size: int) -> bytes:
        return struct.pack(">i20xi", 9994, size // 2) + struct.pack("<ii8d", 1000, 5, *every.min(axis=0), *every.max(axis=0), 0, 0, 0, 0)

    return head(at) + b"".join(records), head(100 + 8 * len(index)) + b"".join(index)


def encode_attributes(names: list[str], rows: list[list], encoding: str = "utf-8") -> bytes:
    """.dbf of text and number columns (numbers keep 10 decimals)."""
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    kinds = ["N" if c and all(isinstance(v, (int, float)) for v in c if v is not None) else "C" for c in columns]
    text = [["" if v is None else (f"{v:.10f}".rstrip("0").rstrip(".") if k == "N" else str(v)) for v in c] for c, k in zip(columns, kinds)]
    widths = [max([1, *[len(t.encode(encoding)) for t in c]]) for c in text]
    out = struct.pack("<B3BIHH20x", 3, 100, 1, 1, len(rows), 33 + 32 * len(names), 1 + sum(widths))
    for name, kind, width in zip(names, kinds, widths):
        out += struct.pack("<11sc4xBB14x", name.encode("latin-1")[:10], kind.encode(), width, 10 if kind == "N" else 0)
    out += b"\r"
    for k in range(len(rows)):
        out += b" " + b"".join(c[k].encode(encoding).rjust(w) if kind == "N" else c[k].encode(encoding).ljust(w) for c, w, kind in zip(text, widths, kinds))
    return out + b"\x1a"


def write_shapes(vertices: DataFrame, folder: str, by: str, record: str, attributes: list[str], ring: str = "ring", seq: str = "seq",
                 x: str = "x", y: str = "y") -> DataFrame:
    """Polygons as one shapefile per value of ``by`` (rings are closed; records ascend by ``record``); returns (path, n_records).
    ``attributes``: columns that are constant in a record.  A task holds the polygons of one file."""
    kind = vertices.schema[by].dataType

    def save(key, rows):
        import pandas as pd

        rows = rows.sort_values([record, ring, seq], ignore_index=True)
        rows = rows[rows[record].notna()]
        # rings and records are runs of the sorted rows: they are cut, not looked up one by one
        rec, part, xy = rows[record].to_numpy(), rows[ring].to_numpy(), rows[[x, y]].to_numpy(float)
        new_record = np.ones(len(rows), bool)
        new_record[1:] = rec[1:] != rec[:-1]
        new_ring = new_record.copy()
        new_ring[1:] |= part[1:] != part[:-1]
        known = rows[ring].notna().to_numpy()
        starts = np.flatnonzero(new_ring)
        ends, of = np.append(starts[1:], len(rows)), np.cumsum(new_record) - 1
        shapes = [[] for _ in range(int(new_record.sum()))]
        for i, j in zip(starts.tolist(), ends.tolist()):
            if known[i]:
                shapes[of[i]].append(np.concatenate([xy[i:j], xy[i:i + 1]]))
        heads = rows[new_record]
        table = list(map(list, zip(*[heads[c].tolist() for c in [record, *attributes]])))
        table = [[v.item() if isinstance(v, np.generic) else v for v in r] for r in table]
        base = f"{folder}/{by}_{key[0]}"
        shp, shx = encode_shapes(shapes)
        write_bytes(base + ".shx", shx)
        write_bytes(base + ".dbf", encode_attributes([record, *attributes], table))
        write_bytes(base + ".shp", shp)
        return pd.DataFrame({"path": [base + ".shp"], "n_records": [len(shapes)]})

    keep = list(dict.fromkeys([by, record, *attributes, ring, seq, x, y]))
    assert not isinstance(kind, T.StructType)
    return vertices.select(*keep).groupBy(by).applyInPandas(save, "path string, n_records long")
