"""Hand-made trips, one per rule of the pipeline, as rows of a CSV file."""

from fareflow.schema import RAW

TRIPS = {
    # id repeated: 30 minutes, 10 units, both copies alike
    "copy_1": ["A", "d1", "2", "01-01-2024 20:00", "01-01-2024 20:30", "Bronx", "Queens", "10", "10", "2", "12"],
    "copy_2": ["A", "d1", "2", "01-01-2024 20:00", "01-01-2024 20:30", "Bronx", "Queens", "10", "10", "2", "12"],
    # 50 units in a minute, unknown zone, no total, passengers "1.0"
    "fast": ["B", "d1", "1.0", "01-01-2024 10:00", "01-01-2024 10:01", "EWR", "Queens", "50", "10", "2", None],
    # ends before it starts
    "backwards": ["C", "d2", "1", "01-01-2024 10:30", "01-01-2024 10:00", "Queens", "Bronx", "5", "10", "2", "12"],
    # no id and 1410 minutes
    "no_id_long": [None, "d2", "1", "01-01-2024 00:00", "01-01-2024 23:30", "Queens", "Bronx", "5", "10", "2", "12"],
    # nothing parses
    "junk": ["D", "d3", "x", "2024-01-01 10:00", "01-01-2024 10:30", "Bronx", "Bronx", "abc", "10", "2", "12"],
    # too fast and too long
    "both": ["E", "d3", "1", "01-01-2024 00:00", "01-01-2024 10:00", "Bronx", "Bronx", "9999", "10", "2", "12"],
    # first copy breaks a rule, second copy does not
    "bad_first": ["F", "d4", "1", "01-01-2024 08:00", "01-01-2024 08:01", "Bronx", "Bronx", "90", "10", "2", "12"],
    "good_later": ["F", "d4", "1", "01-01-2024 09:00", "01-01-2024 09:30", "Bronx", "Bronx", "5", "10", "2", "12"],
    # total below fare; total unknown as the tip is missing
    "low_total": ["G", "d5", "1", "01-01-2024 10:00", "01-01-2024 10:30", "Brooklyn", "Bronx", "5", "10", "2", "8"],
    "no_total": ["H", "d5", "1", "01-01-2024 10:00", "01-01-2024 10:30", "Manhattan", "Bronx", "5", "10", None, None],
    # one-digit day, month and hour
    "loose_time": ["I", "d6", "1", "1-1-2024 9:05", "01-01-2024 09:30", "Staten Island", "Bronx", "5", "10", "2", "12"],
    # no pickup zone
    "no_zone": ["J", "d6", "1", "01-01-2024 10:00", "01-01-2024 10:30", None, "Bronx", "5", "10", "2", "12"],
}


def frame(spark, *names):
    """Trips as a raw table; arrival follows the order of the names."""
    from pyspark.sql import functions as F

    names = names or tuple(TRIPS)
    schema = "position int, " + ", ".join(f"{name} string" for name in RAW.names)
    rows = spark.createDataFrame([(n, *TRIPS[name]) for n, name in enumerate(names)], schema)
    return rows.select(
        *RAW.names,
        F.lit("trips.csv").alias("source_file"),
        F.timestamp_seconds(F.col("position") + 1_704_000_000).alias("ingestion_timestamp"),
    )


def write_csv(path, *names, columns=None):
    columns = columns or RAW.names
    lines = [",".join(columns)]
    for name in names or TRIPS:
        values = dict(zip(RAW.names, TRIPS[name]))
        lines.append(",".join(values.get(column) or "" for column in columns))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
