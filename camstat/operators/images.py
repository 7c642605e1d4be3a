"""Pixel statistics.

Decoded images come from Spark's ``image`` source (``struct(origin, height,
width, nChannels, mode, data)``, BGR byte order, row-major).  Per-image
statistics are computed with numpy inside ``mapInPandas`` (Arrow batches, one
image at a time, bounded by ``spark.sql.execution.arrow.maxRecordsPerBatch``).
The same index definitions are also available as plain Spark aggregates over
long pixel rows, which is what the driver-table queries use.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from camstat.functions.colour import hue_degrees

INDEX_COLUMNS = ["r_av", "g_av", "b_av", "r_sd", "g_sd", "b_sd", "bri_av", "bri_sd",
                 "gi_av", "gi_sd", "gei_av", "gei_sd", "ri_av", "ri_sd", "bi_av", "bi_sd"]


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """Decoded 3-channel images (others are dropped, as the source does)."""
    img = spark.read.format("image").option("dropInvalid", True).load(path)
    return (img.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"),
                       F.col("image.width").alias("width"), F.col("image.nChannels").alias("n_channels"),
                       F.col("image.data").alias("data"))
            .filter(F.col("n_channels") == 3))


def colour_indices(pixels: DataFrame, key: list[str], r: str = "r", g: str = "g", b: str = "b") -> DataFrame:
    """A29 on long pixel rows: channel mean / sd, brightness (r+g+b), green, red
    and blue chromatic shares and green excess (2g - r - b); 16 statistics.
    Ratios on black pixels are null and skipped (``na.rm``)."""
    R, G, B = (F.col(c).cast("double") for c in (r, g, b))
    s = R + G + B
    feats = {"r": R, "g": G, "b": B, "bri": s,
             "gi": F.when(s != 0, G / s), "gei": 2 * G - (R + B),
             "ri": F.when(s != 0, R / s), "bi": F.when(s != 0, B / s)}
    aggs = []
    for name, e in feats.items():
        aggs += [F.avg(e).alias(f"{name}_av"), F.stddev_samp(e).alias(f"{name}_sd")]
    return pixels.groupBy(*key).agg(*aggs).select(*key, *INDEX_COLUMNS)


def greenness(pixels: DataFrame, key: list[str], r: str = "r", g: str = "g", b: str = "b",
              lo: float = 125.0, hi: float = 175.0) -> DataFrame:
    """Mean hue, share of pixels with hue in [lo, hi], the green ratio as the
    source computes it (channel 1 over channels 2 + 3, i.e. red / (green + blue))
    and the corrected green / (red + blue)."""
    h = hue_degrees(r, g, b)
    R, G, B = (F.col(c).cast("double") for c in (r, g, b))
    return (pixels.groupBy(*key)
            .agg(F.avg(h).alias("hue_mean"),
                 F.avg(((h >= lo) & (h <= hi)).cast("double")).alias("hue_green_share"),
                 (F.sum(R) / (F.sum(G) + F.sum(B))).alias("green_ratio_as_source"),
                 (F.sum(G) / (F.sum(R) + F.sum(B))).alias("green_ratio")))


def _stats_np(bgr: np.ndarray) -> list[float]:
    """The 16 statistics in ``INDEX_COLUMNS`` order for one image (BGR pixels)."""
    b, g, r = (bgr[:, i].astype(np.float64) for i in range(3))
    s = r + g + b
    with np.errstate(divide="ignore", invalid="ignore"):
        feats = {"r": r, "g": g, "b": b, "bri": s, "gi": np.where(s != 0, g / s, np.nan),
                 "gei": 2 * g - (r + b), "ri": np.where(s != 0, r / s, np.nan),
                 "bi": np.where(s != 0, b / s, np.nan)}
    out = {}
    for k, f in feats.items():
        f = f[~np.isnan(f)]
        out[f"{k}_av"] = float(f.mean()) if f.size else np.nan
        out[f"{k}_sd"] = float(f.std(ddof=1)) if f.size > 1 else np.nan
    return [out[c] for c in INDEX_COLUMNS]


def image_indices(images: DataFrame) -> DataFrame:
    """A29 on decoded images (``read_pixels`` output) with numpy per image."""
    schema = "path string, " + ", ".join(f"{c} double" for c in INDEX_COLUMNS)

    def run(batches):
        for pdf in batches:
            rows = []
            for p, h, w, data in zip(pdf["path"], pdf["height"], pdf["width"], pdf["data"]):
                px = np.frombuffer(data, dtype=np.uint8).reshape(int(h) * int(w), 3)
                rows.append([p, *_stats_np(px)])
            yield pd.DataFrame(rows, columns=["path", *INDEX_COLUMNS])

    return images.select("path", "height", "width", "data").mapInPandas(run, schema)


def _hue_np(r: np.ndarray, g: np.ndarray, b: np.ndarray) -> np.ndarray:
    mx = np.maximum(np.maximum(r, g), b)
    mn = np.minimum(np.minimum(r, g), b)
    d = mx - mn
    with np.errstate(divide="ignore", invalid="ignore"):
        h = np.where(d == 0, 0.0,
                     np.where(mx == r, np.mod((g - b) / d, 6.0),
                              np.where(mx == g, (b - r) / d + 2, (r - g) / d + 4)))
    return h * 60.0


def image_greenness(images: DataFrame, lo: float = 125.0, hi: float = 175.0) -> DataFrame:
    """A30 on decoded images (``read_pixels`` output), numpy per image: mean hue,
    share of hues in [lo, hi], green ratio as the source computes it and the
    corrected one (same definitions as ``greenness``)."""
    schema = ("path string, hue_mean double, hue_green_share double, green_ratio_as_source double, "
              "green_ratio double")

    def run(batches):
        for pdf in batches:
            rows = []
            for p, h, w, data in zip(pdf["path"], pdf["height"], pdf["width"], pdf["data"]):
                px = np.frombuffer(data, dtype=np.uint8).reshape(int(h) * int(w), 3).astype(np.float64)
                b, g, r = px[:, 0], px[:, 1], px[:, 2]
                hue = _hue_np(r, g, b)
                sr, sg, sb = r.sum(), g.sum(), b.sum()
                rows.append([p, float(hue.mean()), float(((hue >= lo) & (hue <= hi)).mean()),
                             float(sr / (sg + sb)) if sg + sb else np.nan,
                             float(sg / (sr + sb)) if sr + sb else np.nan])
            yield pd.DataFrame(rows, columns=["path", "hue_mean", "hue_green_share",
                                              "green_ratio_as_source", "green_ratio"])

    return images.select("path", "height", "width", "data").mapInPandas(run, schema)


def crop_manifest(anns: DataFrame, width: str = "original_width", height: str = "original_height",
                  root: str = "") -> DataFrame:
    """P3 manifest: pixel box from percent box (F20) and the crop file name (F8);
    null species, Human and Vehicle get no name."""
    from camstat.functions.geometry import pct_to_pixels
    from camstat.functions.ids import crop_name
    return anns.withColumns({
        "px_x": F.floor(pct_to_pixels("value_x", width)).cast("int"),
        "px_y": F.floor(pct_to_pixels("value_y", height)).cast("int"),
        "px_w": F.ceil(pct_to_pixels("value_width", width)).cast("int"),
        "px_h": F.ceil(pct_to_pixels("value_height", height)).cast("int"),
        "crop_name": crop_name("species", "id"),
    })


def crop_pixels(images: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """P3 pixels: cut each manifest box out of its decoded image (BGR bytes) and
    return it as a binary column with its size.  The manifest is grouped per image first,
    so every decoded image is moved once, however many boxes it has.  JPEG encoding is left
    to the writer (no image codec library here)."""
    box = F.struct("crop_name", "px_x", "px_y", "px_w", "px_h")
    cuts = (manifest.filter(F.col("crop_name").isNotNull()).groupBy(F.col(key).alias("_key"))
            .agg(F.collect_list(box).alias("cuts")))
    j = images.join(cuts, F.col(key) == F.col("_key"), "inner").select("height", "width", "data", "cuts")
    schema = "crop_name string, crop_w int, crop_h int, crop binary"

    def run(batches):
        for pdf in batches:
            for h, w, data, boxes in zip(pdf["height"], pdf["width"], pdf["data"], pdf["cuts"]):
                img = np.frombuffer(data, dtype=np.uint8).reshape(int(h), int(w), 3)
                out = []
                for c in boxes:
                    y0, x0 = max(0, c["px_y"]), max(0, c["px_x"])
                    part = img[y0:y0 + c["px_h"], x0:x0 + c["px_w"]]
                    out.append((c["crop_name"], part.shape[1], part.shape[0], part.tobytes()))
                yield pd.DataFrame(out, columns=["crop_name", "crop_w", "crop_h", "crop"])

    return j.mapInPandas(run, schema)


def _exif_datetime(buf: bytes) -> str | None:
    """Find DateTimeOriginal (tag 0x9003) in a JPEG's APP1/EXIF header bytes."""
    i = buf.find(b"Exif\x00\x00")
    if i < 0:
        return None
    t = buf[i + 6:]
    if len(t) < 8:
        return None
    endian = "<" if t[:2] == b"II" else ">"

    def ifd_entries(off):
        if off + 2 > len(t):
            return []
        n = struct.unpack(endian + "H", t[off:off + 2])[0]
        ents = []
        for k in range(n):
            e = off + 2 + 12 * k
            if e + 12 > len(t):
                break
            tag, typ, cnt, val = struct.unpack(endian + "HHII", t[e:e + 12])
            ents.append((tag, typ, cnt, val, e + 8))
        return ents

    first = struct.unpack(endian + "I", t[4:8])[0]
    for tag, typ, cnt, val, _ in ifd_entries(first):
        if tag == 0x8769:  # EXIF sub-IFD
            for tag2, typ2, cnt2, val2, _ in ifd_entries(val):
                if tag2 == 0x9003 and typ2 == 2:
                    s = t[val2:val2 + cnt2].split(b"\x00")[0]
                    return s.decode("ascii", "replace")
    return None


def read_exif_segment(f) -> bytes:
    """The EXIF segment of an open JPEG file, whole, or nothing: segment lengths are followed
    from the start of the file, so it is found behind any other segments."""
    if f.read(2) != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    while True:
        mark = f.read(1)
        while mark and mark != b"\xff":
            mark = f.read(1)
        code = f.read(1)
        while code == b"\xff":
            code = f.read(1)
        if not code or code in (b"\xd9", b"\xda"):  # end of image, or its data begins
            return b""
        if code == b"\x01" or b"\xd0" <= code <= b"\xd7":
            continue
        size = f.read(2)
        if len(size) < 2:
            return b""
        n = struct.unpack(">H", size)[0] - 2
        if code == b"\xe1":
            data = f.read(n)
            if data.startswith(b"Exif\x00\x00"):
                return data
        else:
            f.seek(n, 1)


def read_capture_times(spark: SparkSession, root: str, pattern: str = "*.[jJ][pP]*[gG]", strict: bool = False) -> DataFrame:
    """Capture time per image from the EXIF header.  Files are listed by the
    ``binaryFile`` source selecting the path only; each task then follows the segments of its
    files.  ``exif_date_time_original`` is null when the tag is missing (``has_time`` false);
    ``error`` tells why a file could not be read.  ``strict``: a file without a time, or
    unreadable, fails the job."""
    from camstat.sources.fileio import open_input

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(root).select("path"))

    def one(path):
        try:
            with open_input(path) as f:
                return _exif_datetime(read_exif_segment(f)), None
        except (OSError, ValueError) as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches):
        for pdf in batches:
            got = [one(p) for p in pdf["path"]]
            for p, (t, e) in zip(pdf["path"], got):
                if strict and t is None:
                    raise ValueError(f"{p} has no capture time ({e or 'tag missing'})")
            yield pd.DataFrame({"path": pdf["path"], "exif_date_time_original": [t for t, _ in got], "error": [e for _, e in got]})

    out = files.mapInPandas(run, "path string, exif_date_time_original string, error string")
    return out.withColumn("has_time", F.col("exif_date_time_original").isNotNull())
