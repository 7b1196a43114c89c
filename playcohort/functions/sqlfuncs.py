"""The named functions for SQL users, as native SQL functions (no Python at run time)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from playcohort import constants as C
from playcohort.functions.device import device_md5_sql
from playcohort.functions.ladder import once_sql, rate_sql, tiers_sql

DEFINITIONS = {
    "getchannel": f"""
        (channel STRING, part STRING) RETURNS STRING RETURN
        CASE WHEN channel = '{C.UNKNOWN_ACCOUNT_CHANNEL}' THEN if(part = '0', channel, '')
             WHEN channel IS NULL OR channel IN ('', '0') THEN if(part = '0', '{C.DEFAULT_CHANNEL}', '')
             WHEN part = '0' THEN coalesce(nullif(split_part(channel, '_', 1), ''), '{C.DEFAULT_CHANNEL}')
             WHEN part = '1' THEN split_part(channel, '_', 2)
             WHEN part = '2' THEN split_part(channel, '_', 3) END""",
    "getdivideladder": "(ladder STRING, amount STRING) RETURNS STRING RETURN "
    + once_sql(tiers_sql("ladder"), "tiers", rate_sql("tiers", "try_cast(amount AS BIGINT)")),
    "devicemd5": f"(imei STRING) RETURNS STRING RETURN {device_md5_sql('imei')}",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the temporary functions; returns their names."""
    for name, definition in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{definition}")
    return list(DEFINITIONS)
