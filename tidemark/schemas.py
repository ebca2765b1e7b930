"""Explicit schemas for every source and table. Jobs never infer a schema."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Stored sums: a cell of valid amounts may add up to more than MONEY holds.
WIDE = T.DecimalType(38, 2)

# Raw daily trip file (the 18-column yellow-taxi layout). Pickup and drop-off
# are wall-clock times without zone, so they are read as timestamp_ntz.
RAW_TRIPS = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.DoubleType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.DoubleType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
    ]
)

# Bronze: the raw columns as landed plus the file they came from (optional copy).
BRONZE = T.StructType([*RAW_TRIPS.fields, T.StructField("source_file", T.StringType())])

# Columns the pipeline reads from a raw file; everything else is pruned at the scan.
TRIP_COLUMNS = ("tpep_pickup_datetime", "PULocationID", "total_amount")

# Zone lookup CSV (header row; LocationID and Zone are used).
ZONES = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

# Silver: typed trips, partitioned by (p_date, source_file) so a retried or
# replayed file replaces only its own rows.
SILVER = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("total_amount", MONEY),
        T.StructField("p_date", T.DateType()),
        T.StructField("source_file", T.StringType()),
    ]
)

# Rows of one batch after the casts, whatever types their files had: the silver values, the
# reason of a rejected row, and its raw values for the quarantine.
TYPED = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("zone_id", T.IntegerType()),
        T.StructField("amount", MONEY),
        T.StructField("reason", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
    ]
)

# Rows rejected by the silver step, kept with the reason, partitioned by file.
QUARANTINE = T.StructType(
    [
        T.StructField("reason", T.StringType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("source_file", T.StringType()),
    ]
)

# Gold cells: revenue per (date, hour, zone id) over all trips, matched or not.
CELLS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("total_amount", WIDE),
        T.StructField("n_trips", T.LongType()),
        T.StructField("p_date", T.DateType()),
    ]
)

# Gold file cells: the same grain per source file, partitioned like silver. A
# date's cells are the sum over its files' cells, so a late or replayed file
# never forces a re-read of the other files' trip rows.
FILE_CELLS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("total_amount", WIDE),
        T.StructField("n_trips", T.LongType()),
        T.StructField("p_date", T.DateType()),
        T.StructField("source_file", T.StringType()),
    ]
)

# Gold hour_denorm: revenue per (zone name, date, hour), matched zones only.
HOUR_DENORM = T.StructType(
    [
        T.StructField("zone", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("total_amount", MONEY),
        T.StructField("p_date", T.DateType()),
    ]
)

# Gold overflow: the cells of hour_denorm whose revenue DECIMAL(18,2) cannot hold, exact.
OVERFLOW = T.StructType([T.StructField(f.name, WIDE if f.name == "total_amount" else f.dataType) for f in HOUR_DENORM])

# Gold day_hours: revenue per (date, hour) over all trips, unmatched zones
# included; 24 rows per date, the compact input of the serving table.
DAY_HOURS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("revenue", WIDE),
        T.StructField("p_date", T.DateType()),
    ]
)

# Serving: 24 rows, cumulative revenue and average hourly revenue per hour of day.
SERVING = T.StructType(
    [
        T.StructField("hour", T.IntegerType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("avg_revenue", T.DoubleType()),
        T.StructField("n_days", T.LongType()),
    ]
)

# File ledger: one event per (file, status) transition; current state is the latest event.
LEDGER = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("p_day", T.DateType()),
    ]
)

# Ledger status names in processing order.
STATUSES = ("bronze", "silver", "gold", "done")
