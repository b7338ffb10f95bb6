"""Small hand-made trips."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)


def trip(at="2024-01-10 08:15:00", minutes=10, zone=1, to=2, pay=1, miles=2.0, fare=10.0, total=None, **more):
    pickup = datetime.fromisoformat(at)
    row = {
        "VendorID": 1,
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": pickup + timedelta(minutes=minutes),
        "PULocationID": zone,
        "DOLocationID": to,
        "payment_type": pay,
        "trip_distance": miles,
        "fare_amount": fare,
        "total_amount": fare if total is None else total,
        "tip_amount": 1.0,
        "tolls_amount": 0.0,
        "congestion_surcharge": 2.5,
        "Airport_fee": 0.0,
        "cbd_congestion_fee": 0.75,
    }
    return tuple({**row, **more}[name] for name in SCHEMA.names)


def frame(spark, *trips):
    return spark.createDataFrame(list(trips), SCHEMA)


def demand_frame(spark, rows):
    """(zone, hour text, demand) rows as sparse demand."""
    data = [(z, datetime.fromisoformat(h), d) for z, h, d in rows]
    return spark.createDataFrame(data, "LocationID INT, pickup_hour TIMESTAMP_NTZ, demand BIGINT")


def zones_frame(spark, *ids):
    rows = [(i, f"Borough {i % 2}", f"Zone {i}", "Airports" if i == 1 else "Boro Zone") for i in ids]
    return spark.createDataFrame(
        rows, "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
    )
