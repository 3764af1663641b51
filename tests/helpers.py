import datetime as dt

from tidegate import schemas

BASE = (dt.date(2022, 1, 1), dt.date(2022, 1, 15))
TARGET = dt.date(2022, 2, 10)


def feature(trip_id="a", day=TARGET, **given):
    """One feature row that passes every filter unless told otherwise."""
    at = dt.datetime.combine(day, dt.time(8))
    row = dict(
        trip_id=trip_id,
        pickup_datetime=at,
        dropoff_datetime=at + dt.timedelta(minutes=10),
        vendor_id="1",
        passenger_count=1,
        trip_distance=2.0,
        fare_amount=10.0,
        total_amount=14.0,
        tip_amount=3.0,
        payment_type="1",
        is_high_tip=1,
        scoring_date=day,
    )
    row.update(given)
    return tuple(row[f.name] for f in schemas.FEATURES)


def features(spark, rows):
    return spark.createDataFrame(rows, schemas.FEATURES)


def day_rows(day, fares, prefix=""):
    return [
        feature(f"{prefix}{day}-{i}", day, fare_amount=float(f), is_high_tip=int(f > 20), vendor_id=str(i % 3))
        for i, f in enumerate(fares)
    ]
