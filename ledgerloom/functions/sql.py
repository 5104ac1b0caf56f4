"""The functions most used in plain SQL, as temporary SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .keys import KEY_MODULUS, PIECE_DIGITS

NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?$"


def _hash_mod_key() -> str:
    rest = "0"
    for start in range(0, 64, PIECE_DIGITS):
        digits = min(PIECE_DIGITS, 64 - start)
        piece = f"CAST(conv(substring(sha2(value, 256), {start + 1}, {digits}), 16, 10) AS BIGINT) % {KEY_MODULUS}"
        rest = f"(({rest}) * {16**digits % KEY_MODULUS}L + {piece}) % {KEY_MODULUS}"
    return f"CASE WHEN value IS NOT NULL THEN {rest} END"


DEFINITIONS = {
    "hash_mod_key(value STRING) RETURNS BIGINT": _hash_mod_key(),
    "gps_reason(lat STRING, lon STRING) RETURNS STRING": """
        CASE WHEN lat IS NULL OR lon IS NULL OR lat = '' OR lon = '' THEN 'empty'
             WHEN try_cast(trim(lat) AS DOUBLE) IS NULL OR try_cast(trim(lon) AS DOUBLE) IS NULL
               OR isnan(try_cast(trim(lat) AS DOUBLE)) OR isnan(try_cast(trim(lon) AS DOUBLE)) THEN 'not_a_number'
             WHEN try_cast(trim(lat) AS DOUBLE) = 0 AND try_cast(trim(lon) AS DOUBLE) = 0 THEN 'null_island'
             WHEN NOT (try_cast(trim(lat) AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(trim(lon) AS DOUBLE) BETWEEN -180 AND 180)
             THEN 'out_of_bounds' ELSE 'ok' END""",
    "parse_numeric_range(value STRING, is_price BOOLEAN) RETURNS STRUCT<low DOUBLE, high DOUBLE>": f"""
        transform(array(transform(
          split(replace(replace(regexp_replace(regexp_replace(lower(trim(value)), CASE WHEN is_price THEN '[$,]' ELSE 'a^' END, ''),
                'beds|bed', ''), 'studio', '0'), ' ', ''), CASE WHEN contains(value, '–') THEN '–' ELSE '-' END, 2),
          side -> CASE WHEN side RLIKE '{NUMBER}' THEN try_cast(side AS DOUBLE) END)),
          n -> CASE WHEN get(n, 0) IS NOT NULL AND element_at(n, -1) IS NOT NULL
                    THEN named_struct('low', get(n, 0), 'high', element_at(n, -1))
                    ELSE named_struct('low', CAST(NULL AS DOUBLE), 'high', CAST(NULL AS DOUBLE)) END)[0]""",
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
