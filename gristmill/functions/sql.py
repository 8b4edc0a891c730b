"""SQL functions for ``spark.sql`` users (survey 2.P): SQL bodies, so they are planned like any expression."""

from __future__ import annotations

from pyspark.sql import SparkSession

BODIES = {
    "hamming64(a BIGINT, b BIGINT) RETURNS INT": "bit_count(a ^ b)",
    "match_key(t STRING) RETURNS STRING": r"lower(trim(regexp_replace(t, '\\s+', ' ')))",
    "hash_bucket(k STRING, modulus BIGINT) RETURNS BIGINT": "pmod(CAST(conv(substring(sha2(k, 256), 1, 8), 16, 10) AS BIGINT), modulus)",
    "haversine_m(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE) RETURNS DOUBLE": "2 * 6371000 * asin(least(1D, sqrt(pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2))))",
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; returns their names (P5)."""
    for head, body in BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.partition("(")[0] for h in BODIES]
