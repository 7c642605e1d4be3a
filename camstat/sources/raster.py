"""Raster files (S8): GeoTIFF read tile by tile, and written sheet by sheet.

Headers are read in tasks and give one row per tile or strip with its place in the file; those rows are dealt over
all tasks, and each task reads and decodes only the byte ranges of its tiles.  No task ever holds a whole
raster.  Classic and big files of either byte order, tiles or strips, chunky or planar bands, integer and
floating samples, without compression or with deflate, LZW or PackBits, with or without horizontal differencing.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camstat.sources.fileio import open_input, write_bytes

#: Sizes of field types, sample kinds by format and bits, and names of the tags that are read.
_FIELD = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_SAMPLE = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 8): "i1", (2, 16): "i2", (2, 32): "i4", (3, 32): "f4", (3, 64): "f8"}
_TAG = {256: "width", 257: "height", 258: "bits", 259: "compression", 273: "offsets", 277: "bands", 278: "strip_rows", 279: "sizes", 284: "planar",
        317: "predictor", 322: "tile_width", 323: "tile_height", 324: "offsets", 325: "sizes", 339: "format", 33550: "scale", 33922: "tie",
        34264: "transform", 34735: "keys", 42113: "nodata"}
#: Bytes of tiles that one task decodes.
TASK_BYTES = 16 << 20

_TILES = ("path string, epsg int, offset long, size long, row0 long, col0 long, rows int, cols int, stored_rows int, stored_cols int, band int, bands int, "
          "sample string, compression int, predictor int, nodata double, x0 double, y0 double, dx double, dy double")
CELLS = "path string, epsg int, band int, row long, col long, x double, y double, value double"


def read_header(f) -> dict:
    """The tags of the first image of an open TIFF file."""
    head = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    magic = struct.unpack(f"{order}H", head[2:4])[0] if order else 0
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    at = struct.unpack(f"{order}Q", head[8:16])[0] if big else struct.unpack(f"{order}I", head[4:8])[0]
    f.seek(at)
    n = struct.unpack(order + ("Q" if big else "H"), f.read(8 if big else 2))[0]
    entry, inline = (20, 8) if big else (12, 4)
    table = f.read(n * entry)
    out = {"order": order}
    for k in range(n):
        raw = table[k * entry:(k + 1) * entry]
        tag, kind = struct.unpack(f"{order}HH", raw[:4])
        count = struct.unpack(order + ("Q" if big else "I"), raw[4:12 if big else 8])[0]
        if tag not in _TAG or kind not in _FIELD:
            continue
        code = _FIELD[kind]
        size = struct.calcsize(f"{order}{code}") * count
        data = raw[entry - inline:entry - inline + size]
        if size > inline:
            f.seek(struct.unpack(order + ("Q" if big else "I"), raw[entry - inline:])[0])
            data = f.read(size)
        out[_TAG[tag]] = data.rstrip(b"\0").decode("latin-1") if kind == 2 else list(struct.unpack(order + code * count, data))
    return out


def tiles_of(path: str, h: dict) -> Iterator[tuple]:
    """One tuple per tile or strip, in the order of ``_TILES``."""
    width, height, bands = h["width"][0], h["height"][0], h.get("bands", [1])[0]
    kinds = {(fmt, bits) for fmt, bits in zip(h.get("format", [1]) * bands, h.get("bits", [1]) * bands)}
    if len(kinds) != 1 or (kind := kinds.pop()) not in _SAMPLE:
        raise ValueError(f"{path}: samples of format and bits {kinds or kind} are not read")
    tw = h["tile_width"][0] if "tile_width" in h else width
    th = h["tile_height"][0] if "tile_height" in h else min(h.get("strip_rows", [height])[0], height)
    planar = h.get("planar", [1])[0] == 2 and bands > 1
    across, down = -(-width // tw), -(-height // th)
    keys = {h["keys"][k]: h["keys"][k + 3] for k in range(4, len(h.get("keys", [])) - 3, 4)}
    half = 0.5 if keys.get(1025) != 2 else 0.0  # cells are areas unless the file says points
    if "transform" in h:
        t = h["transform"]
        if t[1] or t[4]:
            raise ValueError(f"{path}: rotated rasters are not read")
        dx, dy, x0, y0 = t[0], t[5], t[3], t[7]
    elif "scale" in h and "tie" in h:
        dx, dy = h["scale"][0], -h["scale"][1]
        x0, y0 = h["tie"][3] - h["tie"][0] * dx, h["tie"][4] - h["tie"][1] * dy
    else:
        dx, dy, x0, y0 = 1.0, 1.0, 0.0, 0.0
    nodata = None
    if "nodata" in h:
        nodata = float(h["nodata"])
    for k, (offset, size) in enumerate(zip(h["offsets"], h["sizes"])):
        plane, at = divmod(k, across * down)
        i, j = divmod(at, across)
        # Tiles are stored whole, beyond the edge too; the last strip is stored short.
        stored = th if "tile_width" in h else min(th, height - i * th)
        yield (path, keys.get(3072, keys.get(2048)), offset, size, i * th, j * tw, min(th, height - i * th), min(tw, width - j * tw), stored, tw,
               plane if planar else 0, 1 if planar else bands, h["order"] + _SAMPLE[kind], h.get("compression", [1])[0],
               h.get("predictor", [1])[0], nodata, x0 + half * dx, y0 + half * dy, dx, dy)


def unpack_lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, most significant bit first, 256 clears and 257 ends."""
    out, table, previous = [], [], b""
    bits = width = 0
    value, size = 0, 9
    for byte in data:
        value, bits = (value << 8) | byte, bits + 8
        while bits >= size:
            code = value >> (bits - size)
            bits -= size
            value &= (1 << bits) - 1
            if code == 257:
                return b"".join(out)
            if code == 256:
                table, size, previous = [], 9, b""
                continue
            if code < 256:
                now = bytes([code])
            elif code - 258 < len(table):
                now = table[code - 258]
            elif previous:
                now = previous + previous[:1]
            else:
                raise ValueError("broken LZW data")
            if previous:
                table.append(previous + now[:1])
            out.append(now)
            previous = now
            width = len(table) + 258
            size = 9 if width < 511 else 10 if width < 1023 else 11 if width < 2047 else 12
    return b"".join(out)


def unpack_bits(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1:at + 2 + n])
            at += 2 + n
        elif n > 128:
            out.append(data[at + 1:at + 2] * (257 - n))
            at += 2
        else:
            at += 1
    return b"".join(out)


def decode(data: bytes, t) -> np.ndarray:
    """(rows, cols, bands) of a tile within the raster; ``t``: a row of the tile table."""
    unpack = {1: bytes, 5: unpack_lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: unpack_bits}.get(t.compression)
    if unpack is None:
        raise ValueError(f"{t.path}: compression {t.compression} is not read")
    data = unpack(data)
    kind = np.dtype(t.sample)
    shape = (t.stored_rows, t.stored_cols, t.bands)
    if t.predictor == 3:
        raise ValueError(f"{t.path}: the floating point predictor is not read")
    x = np.frombuffer(data, kind, int(np.prod(shape))).reshape(shape)
    if t.predictor == 2:
        x = np.cumsum(x, axis=1, dtype=kind.newbyteorder("="))
    return x[:t.rows, :t.cols]


def read_raster(spark: SparkSession, path: str, pattern: str = "*.tif*", keep_empty: bool = False) -> DataFrame:
    """All cells of the GeoTIFF files under ``path``: path, epsg, band, row, col, x, y (centre), value.  Cells that hold
    the file's no-data value are left out, or null with ``keep_empty``.  No files give an empty table."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path"))

    def headers(batches):
        import pandas as pd

        names = [c.split(" ")[0] for c in _TILES.split(", ")]
        for batch in batches:
            for p in batch["path"]:
                with open_input(p) as f:
                    rows = list(tiles_of(p, read_header(f)))
                for k in range(0, len(rows), 10_000):
                    yield pd.DataFrame(rows[k:k + 10_000], columns=names).astype({"epsg": "Int32", "nodata": "float64"})

    tiles = files.mapInPandas(headers, _TILES)
    total = tiles.agg(F.sum("size")).first()[0] or 0
    dealt = tiles.repartition(max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES)), "path", "offset")

    def cells(batches):
        import pandas as pd

        for batch in batches:
            for t in batch.itertuples(index=False):
                with open_input(t.path) as f:
                    f.seek(t.offset)
                    x = decode(f.read(t.size), t)
                rows, cols = np.indices(x.shape[:2])
                rows, cols = rows.reshape(-1) + t.row0, cols.reshape(-1) + t.col0
                for b in range(x.shape[2]):
                    value = x[:, :, b].reshape(-1).astype(np.float64)
                    empty = np.isnan(value) | (value == t.nodata) if t.nodata == t.nodata else np.isnan(value)
                    keep = slice(None) if keep_empty else ~empty
                    yield pd.DataFrame({
                        "path": t.path, "epsg": None if pd.isna(t.epsg) else int(t.epsg), "band": t.band + b, "row": rows[keep], "col": cols[keep],
                        "x": t.x0 + cols[keep] * t.dx, "y": t.y0 + rows[keep] * t.dy, "value": np.where(empty, np.nan, value)[keep]})

    out = dealt.mapInPandas(cells, CELLS)
    return out.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def encode_tiff(x: np.ndarray, x0: float, y0: float, size: float, epsg: int, nodata: float | None = None, tile: int = 64) -> bytes:
    """A tiled, deflated GeoTIFF of one band; ``x0, y0``: upper left corner."""
    height, width = x.shape
    down, across = -(-height // tile), -(-width // tile)
    padded = np.zeros((down * tile, across * tile), x.dtype)
    padded[:height, :width] = x
    blocks = [zlib.compress(np.ascontiguousarray(padded[i * tile:(i + 1) * tile, j * tile:(j + 1) * tile]).astype(x.dtype.newbyteorder("<")).tobytes())
              for i in range(down) for j in range(across)]
    kind = {"u": 1, "i": 2, "f": 3}[x.dtype.kind]
    at, offsets = 8, []
    for b in blocks:
        offsets.append(at)
        at += len(b)
    keys = [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg]
    fields = [(256, 4, [width]), (257, 4, [height]), (258, 3, [x.dtype.itemsize * 8]), (259, 3, [8]), (262, 3, [1]), (277, 3, [1]),
              (322, 3, [tile]), (323, 3, [tile]), (324, 4, offsets), (325, 4, [len(b) for b in blocks]), (339, 3, [kind]),
              (33550, 12, [size, size, 0.0]), (33922, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), (34735, 3, keys)]
    if nodata is not None:
        fields.append((42113, 2, f"{nodata:g}".encode() + b"\0"))
    directory, extra, after = struct.pack("<H", len(fields)), b"", at + 2 + 12 * len(fields) + 4
    for tag, code, values in fields:
        data = values if code == 2 else struct.pack(f"<{len(values)}{_FIELD[code]}", *values)
        place = data.ljust(4, b"\0") if len(data) <= 4 else struct.pack("<I", after + len(extra))
        directory += struct.pack("<HHI", tag, code, len(values)) + place
        if len(data) > 4:
            extra += data + b"\0" * (len(data) % 2)
    return b"II*\0" + struct.pack("<I", at) + b"".join(blocks) + directory + b"\0" * 4 + extra


def write_sheets(cells: DataFrame, folder: str, x0: float, y0: float, size: float, epsg: int, sheet: int = 256, kind: str = "i2",
                 nodata: float = -9999, row: str = "row", col: str = "col", value: str = "value") -> DataFrame:
    """Cells (row, col from the upper left corner ``x0, y0``; one per place) as GeoTIFF sheets of ``sheet`` x ``sheet`` cells, one
    file each; returns (path, n_cells).  Missing and null cells hold the no-data value.  A task holds one sheet."""
    own = cells.select(F.col(row).cast("long").alias("row"), F.col(col).cast("long").alias("col"), F.col(value).cast("double").alias("value"))
    own = own.where("row IS NOT NULL AND col IS NOT NULL").withColumns({"si": F.floor(F.col("row") / sheet), "sj": F.floor(F.col("col") / sheet)})

    def save(key, rows):
        import pandas as pd

        si, sj = int(key[0]), int(key[1])
        x = np.full((sheet, sheet), nodata, kind)
        known = rows[rows["value"].notna()]
        x[(known["row"] - si * sheet).to_numpy(int), (known["col"] - sj * sheet).to_numpy(int)] = known["value"].to_numpy()
        path = f"{folder}/sheet_{si}_{sj}.tif"
        write_bytes(path, encode_tiff(x, x0 + sj * sheet * size, y0 - si * sheet * size, size, epsg, nodata))
        return pd.DataFrame({"path": [path], "n_cells": [len(known)]})

    return own.groupBy("si", "sj").applyInPandas(save, "path string, n_cells long")
