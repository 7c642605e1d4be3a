import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from camstat.functions import projection as P
from camstat.sources import raster as R
from camstat.sources import shapefile as SH


def pack_lzw(data: bytes) -> bytes:
    """A plain encoder, for the decoder's test."""
    out, bits, n = bytearray(), 0, 0

    def put(code, size):
        nonlocal bits, n
        bits, n = (bits << size) | code, n + size
        while n >= 8:
            out.append((bits >> (n - 8)) & 255)
            n -= 8
            bits &= (1 << n) - 1

    table, size, now = {bytes([i]): i for i in range(256)}, 9, b""
    put(256, size)
    for b in data:
        more = now + bytes([b])
        if more in table:
            now = more
            continue
        put(table[now], size)
        table[more] = len(table) + 2
        count = len(table) + 2
        size = 9 if count < 512 else 10 if count < 1024 else 11 if count < 2048 else 12
        if count >= 4094:
            put(256, size)
            table, size = {bytes([i]): i for i in range(256)}, 9
        now = bytes([b])
    put(table[now], size)
    put(257, size)
    if n:
        out.append((bits << (8 - n)) & 255)
    return bytes(out)


def tiff(x, compression=1, tile=None, rows_per_strip=5, predictor=1, order="<", planar=1, big=False, tie=(100.0, 200.0), size=2.0, point=False, nodata=None):
    """A GeoTIFF of (rows, cols, bands) in any of the layouts that the reader takes."""
    height, width, bands = x.shape
    kind = {"u": 1, "i": 2, "f": 3}[x.dtype.kind]

    def block(a, pad=None):
        if pad:
            full = np.zeros((*pad, a.shape[2]), a.dtype)
            full[:a.shape[0], :a.shape[1]] = a
            a = full
        if predictor == 2:
            a = np.concatenate([a[:, :1], np.diff(a, axis=1)], axis=1)
        raw = np.ascontiguousarray(a).astype(a.dtype.newbyteorder(order)).tobytes()
        return {1: bytes, 5: pack_lzw, 8: zlib.compress}[compression](raw)

    planes = [x] if planar == 1 else [x[:, :, b:b + 1] for b in range(bands)]
    blocks = []
    for p in planes:
        if tile:
            blocks += [block(p[i:i + tile, j:j + tile], (tile, tile)) for i in range(0, height, tile) for j in range(0, width, tile)]
        else:
            blocks += [block(p[i:i + rows_per_strip]) for i in range(0, height, rows_per_strip)]
    at = 16
    offsets = []
    for b in blocks:
        offsets.append(at)
        at += len(b)
    long, code = ("Q", 16) if big else ("I", 4)
    fields = [(256, 4, [width]), (257, 4, [height]), (258, 3, [x.dtype.itemsize * 8] * bands), (259, 3, [compression]), (277, 3, [bands]), (284, 3, [planar]),
              (317, 3, [predictor]), (339, 3, [kind] * bands), (33550, 12, [size, size, 0]), (33922, 12, [0, 0, 0, *tie, 0]),
              (34735, 3, [1, 1, 0, 2, 1025, 0, 1, 2 if point else 1, 3072, 0, 1, 32616])]
    fields += [(322, 3, [tile]), (323, 3, [tile]), (324, code, offsets), (325, code, [len(b) for b in blocks])] if tile else [
        (273, code, offsets), (278, 3, [rows_per_strip]), (279, code, [len(b) for b in blocks])]
    if nodata is not None:
        fields.append((42113, 2, str(nodata).encode() + b"\0"))
    fields.sort(key=lambda f: f[0])
    inline, entry = (8, 20) if big else (4, 12)
    directory = struct.pack(order + ("Q" if big else "H"), len(fields))
    after, extra = at + len(directory) + entry * len(fields) + inline, b""
    for tag, kind_, values in fields:
        data = values if kind_ == 2 else struct.pack(f"{order}{len(values)}{R._FIELD[kind_]}", *values)
        place = data.ljust(inline, b"\0") if len(data) <= inline else struct.pack(order + long, after + len(extra))
        directory += struct.pack(order + "HH" + long, tag, kind_, len(values)) + place
        extra += data if len(data) > inline else b""
    mark = {"<": b"II", ">": b"MM"}[order]
    head = mark + (struct.pack(order + "HHHQ", 43, 8, 0, at) if big else struct.pack(order + "HI", 42, at)).ljust(14, b"\0")
    return head + b"".join(blocks) + directory + b"\0" * inline + extra


@pytest.mark.parametrize("layout", [
    {}, {"compression": 8, "tile": 16}, {"compression": 5}, {"compression": 5, "predictor": 2, "tile": 16}, {"order": ">", "compression": 8, "predictor": 2},
    {"planar": 2, "compression": 8}, {"planar": 2, "tile": 16}, {"big": True, "tile": 16, "compression": 8}, {"big": True, "order": ">"}, {"point": True}])
@pytest.mark.parametrize("kind", ["u1", "i2", "f4"])
def test_every_layout(spark, tmp_path, layout, kind):
    if layout.get("predictor") == 2 and kind == "f4":
        pytest.skip("differencing is for integers")
    rng = np.random.default_rng(1)
    x = rng.integers(0, 50, (37, 41, 2)).astype(kind)
    (tmp_path / "a.tif").write_bytes(tiff(x, **layout))
    got = R.read_raster(spark, str(tmp_path)).toPandas()
    assert len(got) == x.size and set(got["epsg"]) == {32616}
    assert (got["value"].to_numpy() == x[got["row"], got["col"], got["band"]]).all()
    half = 0 if layout.get("point") else 1.0
    assert (got["x"] == 100 + half + 2 * got["col"]).all() and (got["y"] == 200 - half - 2 * got["row"]).all()


def test_lzw_of_long_data():
    rng = np.random.default_rng(2)
    for data in (b"", b"a", b"a" * 9000, rng.integers(0, 256, 40_000, dtype=np.uint8).tobytes(), rng.integers(0, 3, 60_000, dtype=np.uint8).tobytes()):
        if data:
            assert R.unpack_lzw(pack_lzw(data)) == data
    assert R.unpack_bits(b"\x02abc\xfex\x80\x00y") == b"abcxxxy"


def test_no_data_and_odd_files(spark, tmp_path):
    x = np.arange(30, dtype="f4").reshape(5, 6, 1)
    x[0, 0], x[1, 1] = -9999, np.nan
    (tmp_path / "a.tif").write_bytes(tiff(x, nodata=-9999))
    assert R.read_raster(spark, str(tmp_path)).count() == 28
    whole = R.read_raster(spark, str(tmp_path), keep_empty=True)
    assert whole.count() == 30 and whole.where("value IS NULL").count() == 2
    assert R.read_raster(spark, str(tmp_path), pattern="*.none").count() == 0
    (tmp_path / "b.tif").write_bytes(b"no image")
    with pytest.raises(Exception, match="not a TIFF"):
        R.read_raster(spark, str(tmp_path)).count()


def test_a_raster_is_read_in_parts(spark, tmp_path):
    """One file of many tiles is decoded by many tasks."""
    x = np.random.default_rng(3).integers(0, 9, (256, 256, 1)).astype("i2")
    (tmp_path / "a.tif").write_bytes(tiff(x, tile=16, compression=8))
    got = R.read_raster(spark, str(tmp_path)).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(got) >= 4 and max(r["count"] for r in got) < 0.6 * 256 * 256


def test_sheets_round_trip(spark, tmp_path):
    cells = spark.createDataFrame([(r, c, (r * 7 + c) % 11 if (r + c) % 5 else None) for r in range(50) for c in range(70)] + [(None, 1, 1)], "row int, col int, value int")
    done = R.write_sheets(cells, str(tmp_path), 300_000.0, 5_600_000.0, 1000.0, 32616, sheet=32)
    assert done.agg(F.sum("n_cells")).first()[0] == cells.where("value IS NOT NULL AND row IS NOT NULL").count()
    got = R.read_raster(spark, str(tmp_path)).select(((5_600_000 - F.col("y")) / 1000 - 0.5).cast("int").alias("row"), ((F.col("x") - 300_000) / 1000 - 0.5).cast("int").alias("col"), F.col("value").cast("int").alias("value"))
    assert got.exceptAll(cells.where("value IS NOT NULL AND row IS NOT NULL")).count() == 0 and got.count() == done.agg(F.sum("n_cells")).first()[0]


SQUARES = [("a", 1, 0, [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)]), ("a", 1, 1, [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0)]),
           ("a", 2, 0, [(9.0, 9.0), (9.5, 9.0), (9.0, 9.5)]), ("b", 3, 0, [(-3.0, 5.0), (-3.0, 6.0), (-2.0, 6.0)])]


def test_shapes_round_trip(spark, tmp_path):
    rows = [(z, rec, f"zone {rec} é", rec * 1.5 if rec > 1 else None, ring, k, x, y) for z, rec, ring, xy in SQUARES for k, (x, y) in enumerate(xy)]
    df = spark.createDataFrame(rows, "site string, rec long, name string, area double, ring int, seq int, x double, y double")
    done = SH.write_shapes(df, str(tmp_path), "site", "rec", ["name", "area"]).collect()
    assert sorted(r["n_records"] for r in done) == [1, 2]
    v, a = SH.read_shapes(spark, str(tmp_path)), SH.read_attributes(spark, str(tmp_path))
    got = v.join(a, ["path", "record"]).select(F.col("rec").cast("long").alias("rec"), "name", "area", "ring", "seq", "x", "y")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([r[1:] for r in rows], key=repr)


def test_many_records_are_read_by_ranges(spark, tmp_path):
    shapes = [[np.array([[k, 0.0], [k, 1.0], [k + 1, 1.0], [k, 0.0]])] if k % 10 else [] for k in range(2000)]
    shp, shx = SH.encode_shapes(shapes)
    (tmp_path / "z.shp").write_bytes(shp)
    (tmp_path / "z.shx").write_bytes(shx)
    (tmp_path / "z.dbf").write_bytes(SH.encode_attributes(["id", "note"], [[k, None if k % 3 else f"n{k}"] for k in range(2000)]))
    v = SH.read_shapes(spark, str(tmp_path))
    assert v.count() == 1800 * 3 and v.where("x - record NOT IN (0, 1)").count() == 0
    a = SH.read_attributes(spark, str(tmp_path))
    assert a.where("id <> record OR (note IS NULL) <> (record % 3 <> 0)").count() == 0 and a.count() == 2000
    assert a.select(F.spark_partition_id()).distinct().count() > 1


def test_projected_shapes_and_no_files(spark, tmp_path):
    east, north = P.utm(16).forward(F.lit(-86.0), F.lit(52.0))
    e, n = spark.range(1).select(east, north).first()
    shp, shx = SH.encode_shapes([[np.array([[e, n], [e + 10, n], [e, n + 10], [e, n]])]])
    (tmp_path / "z.shp").write_bytes(shp)
    (tmp_path / "z.shx").write_bytes(shx)
    first = SH.read_shapes(spark, str(tmp_path), P.utm(16)).where("seq = 0").first()
    assert first["x"] == pytest.approx(-86.0, abs=1e-9) and first["y"] == pytest.approx(52.0, abs=1e-9)
    (tmp_path / "none").mkdir()
    assert SH.read_shapes(spark, str(tmp_path / "none")).count() == 0


def test_other_shapes():
    point = struct.pack("<i2d", 1, 3.0, 4.0)
    line = struct.pack("<i4diii", 3, 0, 0, 1, 1, 1, 2, 0) + np.array([[0, 0], [1, 1.0]]).tobytes()
    many = struct.pack("<i4di", 8, 0, 0, 1, 1, 2) + np.array([[0, 0], [1, 1.0]]).tobytes()
    assert SH.parse_shape(point)[0].tolist() == [[3, 4]] and len(SH.parse_shape(line)[0]) == len(SH.parse_shape(many)[0]) == 2
    assert SH.parse_shape(struct.pack("<i", 0)) == []
    with pytest.raises(ValueError):
        SH.parse_shape(struct.pack("<i", 31))
