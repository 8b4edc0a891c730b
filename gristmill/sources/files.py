"""Readers (survey 2.A): every one is a Spark source, so any file system that Spark reads will do."""

from __future__ import annotations

import io
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jsonl_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object per line; a bad line fails the job (A1)."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def jsonl_recording(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, findings): bad lines become finding rows (A2, A3); blank lines are skipped."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\ufeff", "").alias("line"), F.input_file_name().alias("file")).where("trim(line) <> ''")
    parsed = lines.select("line", "file", F.from_json("line", T.StructType([*schema.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return parsed.where(~bad).select(*[F.col(f"r.{f.name}") for f in schema.fields]), parsed.where(bad).select("file", "line")


def json_document(spark: SparkSession, path: str) -> DataFrame:
    """A whole-file JSON object (A4)."""
    return spark.read.option("multiLine", True).json(path)


def coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images with their annotations, annotations, categories) of a detection document (A5)."""
    box = "array<double>"
    schema = f"images array<struct<id long, file_name string, width int, height int>>, annotations array<struct<id long, image_id long, category_id int, bbox {box}>>, categories array<struct<id int, name string>>"
    doc = spark.read.schema(schema).option("multiLine", True).json(path)
    images, ann = doc.select(F.inline("images")), doc.select(F.inline("annotations"))
    nested = ann.groupBy("image_id").agg(F.sort_array(F.collect_list(F.struct("id", "category_id", "bbox"))).alias("annotations"))
    return images.join(nested, images["id"] == nested["image_id"], "left").drop("image_id"), ann, doc.select(F.inline("categories"))


def csv_table(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8") -> DataFrame:
    """A CSV with a header, strict about its rows; gzip files as well."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("encoding", encoding).csv(path)


def hash_set(spark: SparkSession, path: str) -> DataFrame:
    """One hash a line, lower-cased, distinct."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("hash")).where("hash <> ''").distinct()


def parquet_by_position(spark: SparkSession, path: str, columns: list[str], wanted: DataFrame | None = None) -> DataFrame:
    """Projected parquet rows with file and row number; ``wanted`` (file, row) picks some."""
    df = spark.read.parquet(path).select(*columns, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return df if wanted is None else df.join(wanted, ["file", "row"], "left_semi")


def unique_or_fail(df: DataFrame, key: str, shown: int = 10) -> DataFrame:
    """``df`` if ``key`` is unique, else an error that names some repeated keys."""
    again = [r[0] for r in df.groupBy(key).count().where("count > 1").orderBy(key).limit(shown).collect()]
    if again:
        raise ValueError(f"{key} is not unique: {again}")
    return df


def _unsafe(name: str) -> bool:
    return name.startswith("/") or "\\" in name or ".." in name.split("/")


def archive_members(spark: SparkSession, path: str, names: set[str] | None = None) -> DataFrame:
    """Members of the tar and zip archives below ``path``; see ``members_of``."""
    return members_of(spark.read.format("binaryFile").load(path).select("path", "content"), names)


def members_of(archives: DataFrame, names: set[str] | None = None) -> DataFrame:
    """``file, member, size, unsafe, content`` of archives (path, content).

    An archive is one row and is read in one task, 2 GB at most. The content of a member
    with an unsafe path is null; ``names`` keeps only members with these base names.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, data in zip(pdf["path"], pdf["content"], strict=True):
                rows = []
                if data[:4] == b"PK\x03\x04":
                    with zipfile.ZipFile(io.BytesIO(data)) as z:
                        members = [(m.filename, m.file_size, lambda m=m: z.read(m)) for m in z.infolist() if not m.is_dir()]
                        rows = [(file, n, s, _unsafe(n), None if _unsafe(n) else get()) for n, s, get in members if names is None or n.rpartition("/")[2] in names]
                else:
                    with tarfile.open(fileobj=io.BytesIO(data)) as t:
                        for m in t:
                            if m.isfile() and (names is None or m.name.rpartition("/")[2] in names):
                                rows.append((file, m.name, m.size, _unsafe(m.name), None if _unsafe(m.name) else t.extractfile(m).read()))
                yield pd.DataFrame(rows, columns=["file", "member", "size", "unsafe", "content"])

    return archives.mapInPandas(run, "file string, member string, size long, unsafe boolean, content binary")


def zip_ranges(spark: SparkSession, read_at: Callable[[str, int, int], bytes], archives: DataFrame, wanted: DataFrame | None = None, tail: int = 1 << 16) -> DataFrame:
    """``archive, member, size, content`` of remote zips by byte ranges.

    archives: archive, length. ``read_at(archive, start, stop)`` fetches a range and runs in the
    tasks. The directory at an archive's end is read first, then each member's own range by itself,
    so members are spread over tasks and nothing is downloaded that is not ``wanted`` (archive,
    member). Members are checked by their CRC; zip64 and encrypted members raise.
    """

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for archive, length in zip(pdf["archive"], pdf["length"], strict=True):
                end = read_at(archive, max(0, int(length) - tail), int(length))
                at = end.rfind(b"PK\x05\x06")
                if at < 0:
                    raise ValueError(f"{archive}: no directory at its end")
                count, size, start = struct.unpack("<HII", end[at + 10 : at + 20])
                if count == 0xFFFF or start == 0xFFFFFFFF:
                    raise ValueError(f"{archive}: zip64 is not read")
                data, pos, out = read_at(archive, start, start + size), 0, []
                for _ in range(count):
                    flags, method, crc, packed, plain, n, extra, note, place = struct.unpack("<8xHH4xIIIHHH8xI", data[pos : pos + 46])
                    if flags & 1:
                        raise ValueError(f"{archive}: encrypted member")
                    out.append((archive, data[pos + 46 : pos + 46 + n].decode("utf-8" if flags & 0x800 else "cp437"), plain, packed, method, crc, place))
                    pos += 46 + n + extra + note
                yield pd.DataFrame(out, columns=["archive", "member", "size", "packed", "method", "crc", "place"])

    def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                n, extra = struct.unpack("<HH", read_at(r.archive, r.place + 26, r.place + 30))
                start = r.place + 30 + n + extra
                raw = read_at(r.archive, start, start + r.packed)
                data = raw if r.method == 0 else zlib.decompress(raw, -15)
                if len(data) != r.size or zlib.crc32(data) != r.crc:
                    raise ValueError(f"{r.archive}: {r.member} is damaged")
                out.append((r.archive, r.member, r.size, data))
            yield pd.DataFrame(out, columns=["archive", "member", "size", "content"])

    found = archives.select("archive", "length").mapInPandas(listed, "archive string, member string, size long, packed long, method int, crc long, place long")
    found = found.where(~F.col("member").endswith("/"))
    if wanted is not None:
        found = found.join(wanted, ["archive", "member"], "left_semi")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return found.repartition(parts, "archive", "place").mapInPandas(fetched, "archive string, member string, size long, content binary")


def paged(spark: SparkSession, fetch: Callable[[int, int], str], total: int, length: int) -> DataFrame:
    """``offset, body`` of a service that answers by pages (A17): ``fetch(offset, length)`` runs in the
    tasks, one page a row. The first page's total says how many there are; no page waits for another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"offset": pdf["id"], "body": [fetch(int(i), length) for i in pdf["id"]]})

    return spark.range(0, total, length).mapInPandas(run, "offset long, body string")


def shapefile_points(spark: SparkSession, path: str) -> DataFrame:
    """``file, feature, part, kind, x, y``: the vertices of points, lines and polygons in .shp files.

    Fixed values of the format: a header of 100 bytes, then records of a big-endian number and
    length in 16-bit words, and a little-endian shape: 1 point, 3 line, 5 polygon, 8 multipoint.
    """
    kinds = {1: "point", 3: "line", 5: "polygon", 8: "multipoint"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, data in zip(pdf["path"], pdf["content"], strict=True):
                if struct.unpack(">i", data[:4])[0] != 9994:
                    raise ValueError(f"{file} is no shapefile")
                pos, out = 100, []
                while pos + 12 <= len(data):
                    number, words = struct.unpack(">ii", data[pos : pos + 8])
                    body = data[pos + 8 : pos + 8 + 2 * words]
                    kind = struct.unpack("<i", body[:4])[0]
                    if kind == 1:
                        out.append((file, number, 0, "point", *struct.unpack("<2d", body[4:20])))
                    elif kind == 8:
                        n = struct.unpack("<i", body[36:40])[0]
                        out += [(file, number, 0, "multipoint", *struct.unpack("<2d", body[40 + 16 * k : 56 + 16 * k])) for k in range(n)]
                    elif kind in (3, 5):
                        parts, n = struct.unpack("<ii", body[36:44])
                        starts = [*struct.unpack(f"<{parts}i", body[44 : 44 + 4 * parts]), n]
                        at = 44 + 4 * parts
                        for p, (a, b) in enumerate(zip(starts, starts[1:], strict=False)):
                            out += [(file, number, p, kinds[kind], *struct.unpack("<2d", body[at + 16 * k : at + 16 * k + 16])) for k in range(a, b)]
                    elif kind:
                        raise ValueError(f"{file}: shapes of kind {kind} are not read")
                    pos += 8 + 2 * words
                yield pd.DataFrame(out, columns=["file", "feature", "part", "kind", "x", "y"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.shp").option("recursiveFileLookup", True).load(path)
    return found.select("path", "content").mapInPandas(run, "file string, feature int, part int, kind string, x double, y double")


def inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, length, sha256`` of all files below a folder."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return df.select("path", "length", F.sha2("content", 256).alias("sha256"))


def page_of(rows: DataFrame, reviews: DataFrame, key: str, state: str, order: str, offset: int, limit: int) -> tuple[DataFrame, int]:
    """(page, total) of the cases in a review state; unreviewed ones have no review."""
    latest = reviews.groupBy(key).agg(F.max_by("decision", "reviewed_at").alias("decision"))
    found = rows.join(latest, key, "left").withColumn("decision", F.coalesce("decision", F.lit("unreviewed"))).where(F.col("decision") == state)
    return found.orderBy(order).offset(offset).limit(limit), found.count()


def expect_rows(df: DataFrame, n: int) -> DataFrame:
    """``df`` if it has exactly ``n`` rows, as a pinned dataset must."""
    got = df.count()
    if got != n:
        raise ValueError(f"expected {n} rows, found {got}")
    return df


def find_unique(spark: SparkSession, root: str, name: str) -> str:
    """The path of the one file of this name below ``root``, else an error (A25). No content is read."""
    found = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root).select("path").orderBy("path").limit(5).collect()]
    if len(found) != 1:
        raise ValueError(f"{name!r} is there {len(found)} times below {root}: {found}")
    return found[0]


#: Depth of ``coordinates`` in the geometry kinds of GeoJSON (fixed values of the format).
DEPTHS = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}


def geojson_points(spark: SparkSession, path: str) -> DataFrame:
    """``file, feature, kind, properties, lon, lat``: the vertices of all features.

    A file is one document of the JSON source; coordinates stay text until their depth is known.
    """
    schema = "features array<struct<properties: string, geometry: struct<type: string, coordinates: string>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.input_file_name().alias("file"), F.posexplode("features").alias("feature", "f"))
    text, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    points = F.lit(None)
    for name, depth in DEPTHS.items():
        nested = F.from_json(text, "array<" * (depth + 1) + "double" + ">" * (depth + 1))
        flat = F.array(nested) if depth == 0 else nested
        for _ in range(depth - 1):
            flat = F.flatten(flat)
        points = F.when(kind == name, flat).otherwise(points)
    rows = f.select("file", "feature", kind.alias("kind"), F.col("f.properties").alias("properties"), F.explode(points).alias("p"))
    return rows.select("file", "feature", "kind", "properties", F.get("p", 0).alias("lon"), F.get("p", 1).alias("lat"))
