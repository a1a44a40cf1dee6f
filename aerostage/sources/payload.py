"""Schema-on-read readers of landed payloads (S1-S3, S6, S7) and the flat projections N2-N5, N9.

Every reader declares its schema (nothing is inferred: an airport code like ``0123`` stays text) and
takes request attributes (airport, date, half, direction) from the landing folder names, which Spark
turns into partition columns - a date filter on a read becomes partition pruning.

The plain readers fail on a malformed record (cut off, of a wrong type, or a document over several lines read line by
line); ``multi_line`` reads pretty-printed documents, one to a file. Loads use the ``lines`` readers instead: they
return every line with its file, a malformed one with its text, and ``good`` and ``quarantine`` part them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostage import schemas
from aerostage.functions.casts import parse_local_time, parse_utc_time, try_double_text
from aerostage.operators.nested import explode_array, path

REQUEST_COLUMNS = [("airport_icao", schemas.S), ("flight_date", schemas.D), ("half", schemas.S)]


def with_fields(schema: T.StructType, extra) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(n, t, True) for n, t in extra])


#: Reader option of every JSON feed: no record is lost without an error.
STRICT = {"mode": "FAILFAST"}


def _json(spark: SparkSession, root: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    return spark.read.schema(schema).options(**STRICT).option("multiLine", multi_line).json(root)


def read_schedule_payloads(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """One row per landed payload object: ``departures``, ``arrivals`` arrays and the request columns."""
    return _json(spark, root, with_fields(schemas.SCHEDULE_PAYLOAD, REQUEST_COLUMNS), multi_line)


#: Column with the text of a malformed line, null on a good one.
BAD_LINE = "_bad_line"
#: Share of a load's lines that may be malformed; beyond it the load fails.
MAX_BAD_SHARE = 0.01
QUARANTINE = T.StructType([T.StructField(n, t, True) for n, t in (("feed", schemas.S), ("file_path", schemas.S), ("line", schemas.S))])


def _lines(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    full = with_fields(schema, [(BAD_LINE, schemas.S)])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE)
    return reader.json(root).withColumn("file_path", F.col("_metadata.file_path"))


def schedule_lines(spark: SparkSession, root: str) -> DataFrame:
    """S1 for loads: every line of the landed payloads with its file and, if malformed, its text."""
    return _lines(spark, root, with_fields(schemas.SCHEDULE_PAYLOAD, REQUEST_COLUMNS))


BUNDLE = T.StructType([T.StructField(n, t, True) for n, t in (("airport_icao", schemas.S), ("value", schemas.S), *REQUEST_COLUMNS[1:])])


def bundled_lines(spark: SparkSession, root: str) -> DataFrame:
    """``schedule_lines`` of bundled responses (``landing.write_response_bundles``). A response that is no object is malformed."""
    held = spark.read.schema(BUNDLE).options(**STRICT).json(root)
    known = with_fields(schemas.SCHEDULE_PAYLOAD, [(BAD_LINE, schemas.S)])
    parsed = F.from_json("value", known, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
    return held.select(parsed.alias("r"), *[c for c, _ in REQUEST_COLUMNS], F.col("_metadata.file_path").alias("file_path")).select(
        *[F.col("r")[c].alias(c) for c in known.fieldNames()], *[c for c, _ in REQUEST_COLUMNS], "file_path")


def flight_lines(spark: SparkSession, root: str) -> DataFrame:
    """S2 for loads."""
    return _lines(spark, root, with_fields(schemas.OBSERVED_FLIGHT, [("record_date", schemas.D)]))


def good(lines: DataFrame) -> DataFrame:
    """The well-formed lines, as the plain reader returns them."""
    return lines.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE, "file_path")


def quarantine(lines: DataFrame, feed: str) -> DataFrame:
    """The malformed lines as (feed, file_path, line). A line with one value of a wrong type is malformed as a whole: none
    of its legs is loaded."""
    return lines.where(F.col(BAD_LINE).isNotNull()).select(F.lit(feed).alias("feed"), "file_path", F.col(BAD_LINE).alias("line"))


def counted_lines(lines: DataFrame, feed: str):
    """(lines, observation): the number of all and of malformed lines, taken in the pass that reads them."""
    from pyspark.sql import Observation

    seen = Observation(f"lines-{feed}")
    return lines.observe(seen, F.count(F.lit(1)).alias("n"), F.count(BAD_LINE).alias("bad")), seen


def fail_above(feed: str, n: int, bad: int, most: float = MAX_BAD_SHARE) -> None:
    if bad > most * n:
        raise ValueError(f"Malformed records: {bad} of {n} lines of {feed}, more than a share of {most}")


def _field(name: str, p: str | None, t: T.DataType) -> Column:
    if p is None:
        return F.col(name).cast(t)
    if isinstance(t, T.TimestampNTZType):
        return (parse_local_time(path(p)) if name.endswith("_local") else parse_utc_time(path(p))).alias(name)
    return path(p).cast(t)


def legs_to_raw(payloads: DataFrame, array_col: str, fields, keep_quality: bool = False) -> DataFrame:
    """N5 + N2-N4: payload array to rows, then the flat raw projection (times parsed from text)."""
    legs = explode_array(payloads, array_col, [c for c, _ in REQUEST_COLUMNS])
    cols = [_field(n, p, t).alias(n) for n, p, t in fields]
    if keep_quality:  # N9: the array kept as a value
        cols += [path("departure.quality").alias("departure_quality"), path("arrival.quality").alias("arrival_quality")]
    return legs.select(*cols, F.col("half"))


def departures_from_payloads(payloads: DataFrame, keep_quality: bool = False) -> DataFrame:
    return legs_to_raw(payloads, "departures", schemas.DEPARTURE_FIELDS, keep_quality)


def arrivals_from_payloads(payloads: DataFrame, keep_quality: bool = False) -> DataFrame:
    return legs_to_raw(payloads, "arrivals", schemas.ARRIVAL_FIELDS, keep_quality)


def read_observed_flights(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """Flat observed-flight arrays; ``record_date`` from the folder. Line mode stays splittable;
    ``multi_line`` reads pretty-printed documents (one per file)."""
    schema = with_fields(schemas.OBSERVED_FLIGHT, [("record_date", schemas.D)])
    return _json(spark, root, schema, multi_line)


def read_directional_flights(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """Per-airport directional flights; airport and direction from the folder names."""
    schema = with_fields(schemas.OBSERVED_FLIGHT, [("record_date", schemas.D), ("airport_icao", schemas.S),
                                             ("direction", schemas.S)])
    return _json(spark, root, schema, multi_line)


AIRPORT_TEXT = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schemas.AIRPORTS_CSV.fields])


def read_airports_csv(spark: SparkSession, root: str) -> DataFrame:
    """S3: airport CSV with a header row; numbers are cast safely. An empty load is an error."""
    df = spark.read.schema(AIRPORT_TEXT).option("header", True).option("emptyValue", None).csv(root)
    out = df.select(*[try_double_text(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                      for f in schemas.AIRPORTS_CSV.fields])
    if out.isEmpty():
        raise ValueError(f"airport file at {root} holds no rows")
    return out


DELAY_PAYLOAD = T.StructType([
    T.StructField("airportIcao", T.StringType(), True),
    T.StructField("from", schemas.TIME_PAIR, True),
    T.StructField("to", schemas.TIME_PAIR, True),
    T.StructField("numDeparted", T.LongType(), True),
    T.StructField("numDelayed", T.LongType(), True),
])


def read_delay_payloads(spark: SparkSession, root: str, multi_line: bool = False) -> DataFrame:
    """Airport-delay payloads; the ``from``/``to`` windows as parsed UTC and local times."""
    df = _json(spark, root, DELAY_PAYLOAD, multi_line)
    return df.select(
        F.col("airportIcao").alias("airport_icao"),
        parse_utc_time(path("from.utc")).alias("from_utc"),
        parse_local_time(path("from.local")).alias("from_local"),
        parse_utc_time(path("to.utc")).alias("to_utc"),
        parse_local_time(path("to.local")).alias("to_local"),
        "numDeparted", "numDelayed",
    )
