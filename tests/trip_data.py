"""Rows and names shared by the tests of the trip part."""

from __future__ import annotations

from datetime import datetime, timedelta

SF_DIR = "/root/testdata/sf0.001"

RAW_SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count bigint, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, "
    "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double, Airport_fee double"
)
# Column names and airport ids are fixed values; all else is made up here.
START = datetime(2026, 1, 9, 17, 20)
BASE_TRIP = {
    "VendorID": 2,
    "tpep_pickup_datetime": START,
    "tpep_dropoff_datetime": START + timedelta(minutes=24),
    "passenger_count": 3,
    "trip_distance": 5.5,
    "RatecodeID": 5,
    "store_and_fwd_flag": "Y",
    "PULocationID": 41,
    "DOLocationID": 57,
    "payment_type": 4,
    "fare_amount": 27.25,
    "extra": 0.75,
    "mta_tax": 0.25,
    "tip_amount": 6.5,
    "tolls_amount": 1.25,
    "improvement_surcharge": 0.5,
    "total_amount": 39.0,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
}
ZONE_IDS = (41, 57, 88, 132, 138)
ZONE_CSV = "LocationID,Borough,Zone,service_zone\n" + "".join(
    f"{zone},District {zone % 3},Quarter {zone},{'Airports' if zone in (132, 138) else 'Streets'}\n" for zone in ZONE_IDS
)


def trip(**changes):
    return {**BASE_TRIP, **changes}
