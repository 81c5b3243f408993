"""Hand-made trips, and published figures to check rules against."""

from pyspark.sql import types as T

ZONES = [
    (1, "Manhattan", "Z1", "Yellow Zone"),
    (2, "Queens", "Z2", "Boro Zone"),
    (264, "Unknown", "N/A", "N/A"),
]

TRIP_COLUMNS = [
    "id",
    "taxi_type",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "trip_distance",
    "fare_amount",
    "passenger_count",
    "PULocationID",
    "DOLocationID",
]

KEPT = [
    ("y01", "2023-01-01 00:10:00", "2023-01-01 00:20:00", "0.5", "60.0", "1.0", "1", "2"),
    ("y02", "2023-01-07 23:59:59", "2023-01-08 00:05:00", "0.99", "50.01", "1", "2", "1"),
    ("y03", "2023-01-08 00:00:00", "2023-01-08 00:05:00", "0.5", "60.0", "2.0", "1", "1"),
    ("y04", "2023-01-02 10:00:00", "2023-01-02 10:05:00", "0.5", "50.0", None, "1", "264"),
    ("y05", "2023-01-02 10:00:00", "2023-01-02 10:05:00", "1.0", "60.0", "1.0", "999", None),
    ("y06", "2023-03-01 00:00:00", "2023-03-01 00:05:00", "0.0", "10.0", "0.0", "2.0", "1"),
    ("y07", "2023-03-31 23:59:59", "2023-04-01 00:05:00", "2.0", "10.0", "1.0", "1", "1"),
    ("y08", "2023-03-10 08:00:00", "2023-03-10 08:05:00", "0.0005", "10.0", "1.9", "1", "1"),
    ("y09", "2023-04-01 00:00:00", "2023-04-01 00:05:00", "4.0", "10.0", "1.0", "1", "1"),
    ("y10", "2022-03-05 08:00:00", "2022-03-05 08:05:00", "4.0", "20.0", "1.0", "2", "2"),
]

DROPPED = [
    ("x01", "2023-01-01 00:10:00.5", "2023-01-01 00:20:00", "1.0", "5.0", "1.0", "1", "1"),
    ("x02", "2023-02-30 00:00:00", "2023-03-01 00:20:00", "1.0", "5.0", "1.0", "1", "1"),
    ("x03", "2023-01-01 00:10:00", "junk", "1.0", "5.0", "1.0", "1", "1"),
    ("x04", "2023-01-01 00:10:00", None, "1.0", "5.0", "1.0", "1", "1"),
    ("x05", "2023-01-01 00:10:00", "2023-01-01 00:20:00", "-0.5", "5.0", "1.0", "1", "1"),
    ("x06", "2023-01-01 00:10:00", "2023-01-01 00:20:00", "1.0", "-1.0", "1.0", "1", "1"),
    ("x07", "2023-01-01 00:10:00", "2023-01-01 00:20:00", "NaN", "5.0", "1.0", "1", "1"),
    ("x08", "2023-01-01 00:10:00", "2023-01-01 00:20:00", "abc", "5.0", "1.0", "1", "1"),
    ("x09", "2023-01-01 00:10:00", "2023-01-01 00:20:00", None, "5.0", "1.0", "1", "1"),
    ("x10", "2023-01-01", "2023-01-01 00:20:00", "1.0", "5.0", "1.0", "1", "1"),
    ("x11", "2023-01-01T00:10:00", "2023-01-01 00:20:00", "1.0", "5.0", "1.0", "1", "1"),
    ("x12", "2023-01-01 00:10:00", "2023-01-01 00:20:00", "Infinity", "5.0", "1.0", "1", "1"),
]


def text_schema(columns):
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def with_type(rows, taxi_type):
    return [(row[0], taxi_type, *row[1:]) for row in rows]


BOROUGHS = {
    "yellow_pickup": [
        ("Manhattan", 19596373), ("Queens", 2156255), ("Brooklyn", 153844), ("Bronx", 34636),
        ("Unknown", 251027), ("EWR", 3022), ("Staten Island", 2033),
    ],
    "yellow_dropoff": [
        ("Manhattan", 19583700), ("Queens", 1206699), ("Brooklyn", 876717), ("Bronx", 133958),
        ("Unknown", 322283), ("EWR", 66804), ("Staten Island", 7029),
    ],
    "green_pickup": [
        ("Manhattan", 266942), ("Queens", 120930), ("Brooklyn", 65583), ("Bronx", 10423),
        ("Unknown", 1332), ("EWR", 23), ("Staten Island", 62),
    ],
    "green_dropoff": [
        ("Manhattan", 269076), ("Queens", 118990), ("Brooklyn", 54317), ("Bronx", 17442),
        ("Unknown", 4993), ("EWR", 339), ("Staten Island", 138),
    ],
}

TOP_BOROUGHS = {
    "yellow_pickup": ["Manhattan", "Queens", "Unknown", "Brooklyn", "Bronx"],
    "yellow_dropoff": ["Manhattan", "Queens", "Brooklyn", "Unknown", "Bronx"],
    "green_pickup": ["Manhattan", "Queens", "Brooklyn", "Bronx", "Unknown"],
    "green_dropoff": ["Manhattan", "Queens", "Brooklyn", "Bronx", "Unknown"],
}

JUNE_2023 = [
    122151, 117852, 116954, 99330, 102484, 120140, 122796, 118686, 114179, 111601,
    96177, 106265, 116749, 121704, 126816, 110323, 105105, 91349, 85579, 107277,
    115339, 120531, 113509, 108193, 93648, 99080, 108548, 105063, 104311, 94250,
]
HIGH_DAYS = [1, 6, 7, 14, 15, 22]
LOW_DAYS = [11, 18, 19, 25, 30]
