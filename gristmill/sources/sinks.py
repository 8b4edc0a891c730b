"""Writers (survey 2.B)."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical(df: DataFrame) -> DataFrame:
    """Rows as JSON with sorted keys, one string column ``line``."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("line"))


def write_jsonl(df: DataFrame, path: str, key: str) -> str:
    """Write rows as sorted JSON lines in key order and return a digest over the sorted lines (B1).

    The order is made by range partitions, one file each; the digest is folded from per-row
    hashes and counts, so that no task holds all lines.
    """
    lines = df.orderBy(key)
    canonical(lines).write.mode("overwrite").text(path)
    got = canonical(df).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("line").cast("decimal(38,0)")).alias("h")).first()
    return f"{got.n}:{got.h or 0}"


def publish_if(df: DataFrame, gates: DataFrame, path: str) -> bool:
    """Write only when every gate passes; a failed run leaves what is there untouched."""
    if gates.where("not passed").limit(1).count():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def cross_tab(df: DataFrame, keys: list[str], path: str) -> None:
    """Counts by keys as one sorted CSV."""
    df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(*keys).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def json_report(df: DataFrame, path: str) -> None:
    """One row as a JSON object with sorted keys, in one file (B2)."""
    canonical(df.limit(2)).coalesce(1).write.mode("overwrite").text(path)


def publish_folder(df: DataFrame, path: str, key: str) -> str:
    """Write rows to a fresh folder below ``path`` named by a digest of their content, with a receipt
    beside it that is written last; a reader that finds the receipt finds all rows (B10). Publishing
    equal rows again gives the same name and writes nothing."""
    spark = df.sparkSession
    got = canonical(df).agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("line").cast("decimal(38,0)")).alias("h")).first()
    name = f"{got.n}-{int(got.h or 0) & (1 << 64) - 1:016x}"
    receipt = f"{path}/{name}.receipt"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(receipt)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        df.orderBy(key).write.mode("overwrite").parquet(f"{path}/{name}")
        spark.createDataFrame([(name, got.n)], "name string, rows long").coalesce(1).write.mode("overwrite").json(receipt)
    return name


def write_shards(df: DataFrame, path: str, rows: int) -> None:
    """Files of at most ``rows`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)


def byte_shards(df: DataFrame, group: str, order: str, size: str, budget: int, overhead: int = 4096) -> DataFrame:
    """Next-fit shard numbers within each group: a row that does not fit opens a shard.

    The running sum restarts at each shard, which no window frame expresses; a group is one run.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        shard, used, out = 0, 0, []
        for n in pdf[size]:
            need = int(n) + overhead
            if used and used + need > budget:
                shard, used = shard + 1, 0
            used += need
            out.append(shard)
        return pdf.assign(shard=out)

    return df.groupBy(group).applyInPandas(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in df.schema.fields)}, shard long")


def coco_tables(rows: DataFrame, key: str, boxes: str, classes: str) -> tuple[DataFrame, DataFrame]:
    """(images, annotations) with dense ids from 1."""
    from ..operators.ordering import numbered

    images = numbered(rows.withColumn("__h", F.sha2(F.col(key), 256)), ["__h", key], "__no").withColumn("image_id", F.col("__no") + 1).drop("__no", "__h")
    ann = images.select("image_id", F.posexplode(F.arrays_zip(F.col(boxes).alias("bbox"), F.col(classes).alias("category"))).alias("pos", "a")).select("image_id", "pos", "a.bbox", "a.category")
    ann = ann.withColumn("__h", F.sha2(F.concat_ws(":", "image_id", "pos"), 256))
    ann = numbered(ann, ["__h", "image_id", "pos"], "__no").withColumn("annotation_id", F.col("__no") + 1).drop("__no", "__h", "pos")
    return images.drop(boxes, classes), ann


def zip_archives(df: DataFrame, shard: str, name: str, content: str) -> DataFrame:
    """``shard, archive, sha256``: the rows of each shard as a stored zip, members by name, fixed
    dates, so that equal rows give equal bytes (B8).

    A shard is held in one task: number rows by ``byte_shards``, which bounds its size.
    """
    first_date = (1980, 1, 1, 0, 0, 0)  # the earliest that the format can hold

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for member, data in sorted(zip(pdf["member"], pdf["data"], strict=True)):
                z.writestr(zipfile.ZipInfo(member, first_date), bytes(data or b""))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "archive": [out.getvalue()]})

    kind = dict(df.dtypes)[shard]
    rows = df.select(F.col(shard).alias("shard"), F.col(name).alias("member"), F.col(content).cast("binary").alias("data"))
    return rows.groupBy("shard").applyInPandas(run, f"shard {kind}, archive binary").withColumn("sha256", F.sha2("archive", 256))
