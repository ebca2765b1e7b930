"""Column expressions built from pyspark.sql.functions (JVM side, codegen'd)."""

from tidemark.functions.columns import (  # noqa: F401
    file_date,
    file_month,
    money,
    money_sum,
    wall_clock,
    wide_sum,
    ntz,
    pickup_date,
    pickup_hour,
    reject_reason,
    valid_trip,
    zone_id,
)
