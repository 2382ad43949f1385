"""Declared schemas and column contracts of the trip feeds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Money and distance contract: 9 decimals, wide enough that no sum overflows.
NUMERIC = T.DecimalType(38, 9)


def _struct(spec: str) -> T.StructType:
    """Build a schema from 'name type, name type'."""
    kinds = {
        "int": T.IntegerType(),
        "long": T.LongType(),
        "double": T.DoubleType(),
        "string": T.StringType(),
        "timestamp": T.TimestampType(),
        "timestamp_ntz": T.TimestampNTZType(),
    }
    fields = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in fields])


# Column names, order and types of the published feeds.
YELLOW_CSV = _struct(
    "VendorID long, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count long, "
    "trip_distance double, RatecodeID long, store_and_fwd_flag string, PULocationID long, DOLocationID long, "
    "payment_type long, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double"
)
GREEN_CSV = _struct(
    "VendorID long, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, store_and_fwd_flag string, "
    "RatecodeID long, PULocationID long, DOLocationID long, passenger_count long, trip_distance double, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, "
    "improvement_surcharge double, total_amount double, payment_type long, trip_type long, "
    "congestion_surcharge double"
)
FHV_CSV = _struct(
    "dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp, PUlocationID string, "
    "DOlocationID string, SR_Flag string, Affiliated_base_number string"
)
ZONE_LOOKUP = _struct("LocationID int, Borough string, Zone string, service_zone string")
PAYMENT_TYPE_LOOKUP = _struct("payment_type int, description string")
PAYMENT_LOOKUP = _struct("payment_type_id int, payment_type_name string")
GREEN_EVENT = _struct(
    "lpep_pickup_datetime string, lpep_dropoff_datetime string, PULocationID int, DOLocationID int, "
    "passenger_count double, trip_distance double, tip_amount double, total_amount double"
)
PAGED_TRIP = _struct("trip_pickup_date_time timestamp, tip_amt double, payment_type string")
INGESTED_TRIP = _struct(
    "vendor_id int, pickup_datetime timestamp, dropoff_datetime timestamp, passenger_count double, "
    "trip_distance double, pu_location_id int, do_location_id int, payment_type int, fare_amount double, "
    "tip_amount double, total_amount double, taxi_type string, extracted_at timestamp"
)


@dataclass(frozen=True)
class Field:
    """One contract column: where it comes from, what it is cast to, whether bad text becomes NULL."""

    name: str
    source: str
    dtype: T.DataType
    safe: bool = False


def _fields(spec: str, dtype: T.DataType, safe: bool = False) -> list[Field]:
    """Fields from 'name' or 'name=source' words sharing one type."""
    out = []
    for word in spec.split():
        name, _, source = word.partition("=")
        out.append(Field(name, source or name, dtype, safe))
    return out


# Staging contracts (target name = source name).
_MONEY = "fare_amount extra mta_tax tip_amount tolls_amount"
GREEN_CONTRACT = [
    *_fields("vendor_id=VendorID", T.IntegerType()),
    *_fields("rate_code_id=RatecodeID", T.IntegerType(), safe=True),
    *_fields("pickup_location_id=PULocationID dropoff_location_id=DOLocationID", T.IntegerType()),
    *_fields("pickup_datetime=lpep_pickup_datetime dropoff_datetime=lpep_dropoff_datetime", T.TimestampType()),
    *_fields("store_and_fwd_flag", T.StringType()),
    *_fields("passenger_count", T.LongType()),
    *_fields("trip_distance", NUMERIC),
    *_fields("trip_type", T.IntegerType(), safe=True),
    *_fields(f"{_MONEY} ehail_fee improvement_surcharge total_amount", NUMERIC),
    *_fields("payment_type", T.IntegerType(), safe=True),
]
YELLOW_CONTRACT = [
    *_fields("vendor_id=VendorID rate_code_id=RatecodeID", T.IntegerType()),
    *_fields("pickup_location_id=PULocationID dropoff_location_id=DOLocationID", T.IntegerType()),
    *_fields("pickup_datetime=tpep_pickup_datetime dropoff_datetime=tpep_dropoff_datetime", T.TimestampType()),
    *_fields("store_and_fwd_flag", T.StringType()),
    *_fields("passenger_count", T.LongType()),
    *_fields("trip_distance", NUMERIC),
    *_fields(f"{_MONEY} improvement_surcharge total_amount", NUMERIC),
    *_fields("payment_type", T.IntegerType()),
]
# Money and distance of the contract, which a model may cast once its rows have been reduced.
AMOUNTS = [f.name for f in GREEN_CONTRACT if f.dtype == NUMERIC]
FHV_CONTRACT = [
    *_fields("dispatching_base_num", T.StringType()),
    *_fields("pickup_datetime dropoff_datetime=dropOff_datetime", T.TimestampType()),
    *_fields("pickup_location_id=PUlocationID dropoff_location_id=DOlocationID", T.IntegerType(), safe=True),
    *_fields("sr_flag=SR_Flag affiliated_base_number=Affiliated_base_number", T.StringType()),
]

# The columns the incremental load keeps, and how it names them.
INGEST_KEEP = (
    "VendorID pickup_datetime dropoff_datetime passenger_count trip_distance PULocationID DOLocationID "
    "payment_type fare_amount tip_amount total_amount"
).split()
INGEST_RENAMES = {"VendorID": "vendor_id", "PULocationID": "pu_location_id", "DOLocationID": "do_location_id"}
INGEST_INTEGERS = ["vendor_id", "pu_location_id", "do_location_id", "payment_type"]
EVENT_COLUMNS = [f.name for f in GREEN_EVENT.fields]
