"""Readers that no registered query covers, and image kernels, against plain code."""

import hashlib
import io
import json
import math
import struct
import zipfile

import numpy as np
import pytest

from gristmill.functions import pixels
from gristmill.sources import files


def test_zip_ranges(spark, tmp_path):
    """Only the directory and wanted members are fetched; damaged ones raise."""
    names = {}
    for k in range(3):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for i in range(20):
                z.writestr(f"d/é{i}.txt", f"{k}:{i} " * (i * 50), zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED)
            z.writestr("empty/", "")
        (tmp_path / f"{k}.zip").write_bytes(out.getvalue())
        names[f"{tmp_path}/{k}.zip"] = len(out.getvalue())
    log = tmp_path / "log"

    def read_at(archive, start, stop):
        with open(log, "a") as f:
            f.write(f"{stop - start}\n")
        with open(archive, "rb") as f:
            f.seek(start)
            return f.read(stop - start)

    archives = spark.createDataFrame(list(names.items()), "archive string, length long")
    got = {(r.archive[-5:], r.member): bytes(r.content).decode() for r in files.zip_ranges(spark, read_at, archives).collect()}
    assert got == {(f"{k}.zip", f"d/é{i}.txt"): f"{k}:{i} " * (i * 50) for k in range(3) for i in range(20)}
    log.write_text("")
    wanted = spark.createDataFrame([(f"{tmp_path}/1.zip", "d/é7.txt")], "archive string, member string")
    (r,) = files.zip_ranges(spark, read_at, archives, wanted, tail=4096).collect()
    assert r.size == len("1:7 ") * 350 and sum(map(int, log.read_text().split())) < 3 * 4096 + 3 * 2500
    path = next(iter(names))
    data = bytearray(open(path, "rb").read())
    data[200] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="damaged|decompress|invalid"):
        files.zip_ranges(spark, read_at, archives).collect()


def test_paged(spark):
    service = list(range(103))
    got = files.paged(spark, lambda at, n: json.dumps(service[at : at + n]), len(service), 10)
    assert sorted(x for r in got.collect() for x in json.loads(r.body)) == service and got.count() == 11


def test_shapefile(spark, tmp_path):
    def record(number, body):
        return struct.pack(">ii", number, len(body) // 2) + body

    point = struct.pack("<i2d", 1, 1.5, -2.5)
    ring = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    polygon = struct.pack("<i4d2i2i", 5, 0, 0, 1, 1, 2, 8, 0, 4) + b"".join(struct.pack("<2d", *p) for p in ring + [(x + 5, y) for x, y in ring])
    many = struct.pack("<i4di", 8, 0, 0, 1, 1, 2) + struct.pack("<4d", 1, 2, 3, 4)
    body = record(1, point) + record(2, polygon) + record(3, many) + record(4, struct.pack("<i", 0))
    (tmp_path / "a.shp").write_bytes(struct.pack(">i", 9994) + bytes(96) + body)
    (tmp_path / "a.dbf").write_bytes(b"other")
    got = sorted((r.feature, r.part, r.kind, r.x, r.y) for r in files.shapefile_points(spark, str(tmp_path)).collect())
    want = [(1, 0, "point", 1.5, -2.5)] + [(2, p, "polygon", x + 5 * p, y) for p in (0, 1) for x, y in ring] + [(3, 0, "multipoint", 1, 2), (3, 0, "multipoint", 3, 4)]
    assert got == sorted(want)


def image(w, h, seed):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3)).astype(np.uint8)


def plain_resize(rows, width, height):
    """Sinc-windowed resampling of one channel, one output pixel at a time."""

    def line(values, out):
        n, got = len(values), []
        scale = max(n / out, 1.0)
        sinc = lambda x: 1.0 if x == 0 else math.sin(math.pi * x) / (math.pi * x)
        for k in range(out):
            centre = (k + 0.5) * n / out
            w = [sinc(t) * sinc(t / 3) if abs(t := (i + 0.5 - centre) / scale) < 3 else 0.0 for i in range(n)]
            got.append(min(255, max(0, math.floor(sum(a * b for a, b in zip(w, values, strict=True)) / sum(w) + 0.5))))
        return got

    wide = [line(r, width) if len(r) != width else list(r) for r in rows]
    return list(zip(*[line(list(c), height) if len(wide) != height else list(c) for c in zip(*wide, strict=True)], strict=True))


def test_image_kernels_against_loops():
    for w, h in ((9, 8), (20, 31), (5, 4), (64, 40)):
        rgb = image(w, h, w * h)
        level = [[(19595 * int(p[0]) + 38470 * int(p[1]) + 7471 * int(p[2]) + 32768) >> 16 for p in row] for row in rgb]
        small = plain_resize(level, 9, 8)
        bits = "".join(str(int(small[y][x] > small[y][x + 1])) for y in range(8) for x in range(8))
        assert pixels.difference_hash(rgb) == f"{int(bits, 2):016x}"
        at = plain_resize(level, 32, 32)
        low = [[4 * sum(at[y][x] * math.cos(math.pi * v * (2 * y + 1) / 64) * math.cos(math.pi * u * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for u in range(8)] for v in range(8)]
        middle = sorted(x for r in low for x in r)
        bits = "".join(str(int(x > (middle[31] + middle[32]) / 2)) for r in low for x in r)
        assert pixels.perceptual_hash(rgb) == f"{int(bits, 2):016x}"
        assert pixels.pixel_digest(rgb) == hashlib.sha256(struct.pack(">II", w, h) + rgb.tobytes()).hexdigest()
        channels = [plain_resize(rgb[:, :, c].tolist(), 32, 32) for c in range(3)]
        raw = bytes(channels[c][y][x] & 0xF8 for y in range(32) for x in range(32) for c in range(3))
        assert pixels.thumbnail_digest(rgb) == hashlib.sha256(raw).hexdigest()
    flat = np.full((256, 256, 3), 51, np.uint8)
    bright, contrast, edges = pixels.light(flat)
    assert (bright, contrast) == (0.2, 0.0) and edges == pytest.approx(51 * (256**2 - 254**2) / 256**2 / 255)
    assert pixels.light(image(256, 256, 3))[2] > 0.3


def test_images_with_holes(spark):
    rgb = image(6, 5, 1)
    rows = [(6, 5, bytearray(rgb.tobytes())), (None, 5, bytearray(b"x")), (6, 5, None), (2, 2, bytearray(b"short")), (0, 0, bytearray(b""))]
    got = spark.createDataFrame(rows, "width int, height int, pixels binary").select(pixels.image_marks("width", "height", "pixels").alias("m")).collect()
    assert got[0].m.pixels == pixels.pixel_digest(rgb) and [r.m.dhash for r in got[1:]] == [None] * 4
