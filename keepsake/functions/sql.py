"""The reusable rules as SQL functions, so that they can be called from ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

_FUNCTIONS = {
    "flow_screen(host STRING, device STRING, path STRING) RETURNS STRING": """
        CASE WHEN contains(lower(coalesce(host, '')), 'accounts.')
               OR lower(coalesce(path, '')) RLIKE 'accountmanager|accounts[.]' THEN 'Account Portal'
             WHEN lower(device) IN ('mobile', 'tablet', 'smartphone', 'phone')
               OR contains(lower(coalesce(host, '')), 'mobile') THEN 'SaaS Mobile App'
             WHEN lower(coalesce(host, '')) RLIKE 'app[.]|saas[.]|dashboard' THEN 'SaaS Web App'
             ELSE 'Unknown' END""",
    "partition_year(d DATE) RETURNS STRING": "date_format(d, 'yyyy')",
    "partition_month(d DATE) RETURNS STRING": "date_format(d, 'MM')",
    "safe_divide(n DOUBLE, d DOUBLE, fallback DOUBLE) RETURNS DOUBLE": """
        CASE WHEN d IS NULL OR d = 0 THEN fallback ELSE n / d END""",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session; the optimizer inlines them. Returns their names."""
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [signature.split("(")[0] for signature in _FUNCTIONS]
