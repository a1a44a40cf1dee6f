"""Registered queries over landed payloads: readers, flat projections, nesting operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerostage.functions import casts
from aerostage.operators import variant
from aerostage.operators.nested import align, flatten, path
from aerostage.plans.catalog import query, raw
from aerostage.plans import staging
from aerostage.session import scratch_path
from aerostage.sources import landing, payload

_RAW_OUT_DROP = ["row_id", "ingestion_timestamp", "data_source"]


def land_schedules(spark, sf_dir, *sides: str) -> str:
    """Land the schedule adapters (or only the ``sides`` asked for) as nested payload files; return the landing root."""
    root = scratch_path(spark, "schedules")
    side = lambda name: raw(spark, sf_dir, f"raw_{name}", dealt=True) if not sides or name in sides else None
    landing.write_schedule_payloads(side("departures"), side("arrivals"), root)
    return root


@query("payload_flatten_departures")
def q_payload_flatten_departures(spark, sf_dir):
    """S1 + N2/N3 + N5: land nested payloads, read them back with a fixed schema, departures to flat rows."""
    return payload.departures_from_payloads(payload.read_schedule_payloads(spark, land_schedules(spark, sf_dir, "departures")))


@query("payload_flatten_arrivals")
def q_payload_flatten_arrivals(spark, sf_dir):
    """The arrivals side of the same payloads."""
    return payload.arrivals_from_payloads(payload.read_schedule_payloads(spark, land_schedules(spark, sf_dir, "arrivals")))


@query("array_column")
def q_array_column(spark, sf_dir):
    """The payload's ``quality`` array kept as a value, shown one element per row with its position."""
    legs = payload.departures_from_payloads(payload.read_schedule_payloads(spark, land_schedules(spark, sf_dir, "departures")),
                                            keep_quality=True)
    return legs.select("airport_icao", "flight_date", "number", "callSign",
                       F.posexplode("departure_quality").alias("pos", "quality"))


@query("nested_default")
def q_nested_default(spark, sf_dir):
    """Dotted reads through a missing object give null, or a default when one is asked for."""
    r = raw(spark, sf_dir, "raw_departures")
    nested = r.select("row_id", F.when(F.col("aircraft_modeS").isNotNull(), F.struct(
        F.col("aircraft_reg").alias("reg"), F.col("aircraft_modeS").alias("modeS"),
        F.col("aircraft_model").alias("model"))).alias("aircraft"))
    return nested.select("row_id", path("aircraft.reg").alias("aircraft_reg"),
                         path("aircraft.model", default="unknown").alias("aircraft_model"))


@query("present_null_default")
def q_present_null_default(spark, sf_dir):
    """N1 on undeclared JSON: a null that is present stays null, a missing key or an object that is none gives the default."""
    r = raw(spark, sf_dir, "raw_departures")
    craft = F.struct(F.col("aircraft_reg").alias("reg"), F.col("aircraft_model").alias("model"))
    kind = F.pmod("row_id", F.lit(4))
    text = (F.when(kind == 0, F.to_json(F.struct(craft.alias("aircraft")), {"ignoreNullFields": "false"}))
            .when(kind == 1, F.to_json(F.struct(craft.alias("aircraft"))))
            .when(kind == 2, F.lit('{"aircraft": "n/a"}')).otherwise(F.lit('{"aircraft": null}')))
    v = r.select("row_id", variant.parse(text).alias("v"))
    return v.select("row_id", variant.get_path("v", "aircraft.model", default="unknown").alias("aircraft_model"),
                    variant.get_path("v", "aircraft.reg").alias("aircraft_reg"))


@query("flatten_unknown_keys")
def q_flatten_unknown_keys(spark, sf_dir):
    """N7 + N8 without a schema: the keys of nested records found in the data, flattened, aligned to their union; shown as
    one row for each key that is there."""
    r = raw(spark, sf_dir, "raw_departures")
    clock = F.struct(F.date_format("departure_scheduledtime_utc", "yyyy-MM-dd HH:mm").alias("utc"))
    leg = F.struct(
        "number", "status", "isCargo",
        F.struct(F.col("aircraft_reg").alias("reg"), F.col("aircraft_modeS").alias("modeS")).alias("aircraft"),
        F.struct(F.struct(F.col("departure_terminal").alias("terminal"), clock.alias("scheduledTime")).alias("departure")).alias("movement"),
        F.when(F.pmod("row_id", F.lit(3)) == 0, F.array(F.lit("Basic"), F.col("status"))).alias("quality"))
    flat = variant.flatten_unknown(r.select("row_id", variant.parse(F.to_json(leg)).alias("v")), "v", ["row_id"])
    keys = [c for c in flat.columns if c != "row_id"]
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"`{k}`").alias("value")) for k in keys]))
    return flat.select("row_id", pairs.alias("p")).select("row_id", "p.key", "p.value").where("value is not null")


@query("flatten_struct")
def q_flatten_struct(spark, sf_dir):
    """Nested legs flattened, keys joined by ``_``; depth three (``departure_scheduledTime_utc``)."""
    r = raw(spark, sf_dir, "raw_departures")
    nested = r.select("row_id", landing.leg_struct(r, text_times=False, with_quality=False).alias("leg"))
    return flatten(nested.select("row_id", "leg.*"))


@query("align_keys")
def q_align_keys(spark, sf_dir):
    """Records with different keys aligned to the sorted union of keys, missing ones null."""
    dep = raw(spark, sf_dir, "raw_departures").select(
        "row_id", "number", "departure_terminal", "departure_runway", "arrival_gate", "arrival_baggagebelt",
        F.lit("departure").alias("kind"))
    arr = raw(spark, sf_dir, "raw_arrivals").select(
        "row_id", "number", "departure_terminal", "departure_runway", "arrival_runway", "arrival_gate",
        F.lit("arrival").alias("kind"))
    return align([dep, arr])


def flights_for_landing(spark, sf_dir):
    r = raw(spark, sf_dir, "raw_flights", dealt=True)
    return r.withColumn("record_date", F.to_date(casts.epoch_to_timestamp("firstSeen")))


@query("read_flights_json")
def q_read_flights_json(spark, sf_dir):
    """Observed flights landed as JSON arrays per day, read back with the request date appended."""
    root = scratch_path(spark, "flights")
    landing.write_flight_arrays(flights_for_landing(spark, sf_dir), root)
    return payload.read_observed_flights(spark, root)


@query("read_airports_csv")
def q_read_airports_csv(spark, sf_dir):
    """S3: airport list landed as CSV with a header, read back typed."""
    root = scratch_path(spark, "airports")
    landing.write_airports_csv(raw(spark, sf_dir, "raw_airports"), root)
    return payload.read_airports_csv(spark, root)


@query("directional_flights")
def q_directional_flights(spark, sf_dir):
    """Per-airport departure and arrival flight lists; airport and direction from the folders."""
    fl = flights_for_landing(spark, sf_dir)
    dep = fl.where(F.col("estDepartureAirport").isNotNull()).withColumn(
        "airport_icao", F.upper("estDepartureAirport")).withColumn("direction", F.lit("departure"))
    arr = fl.where(F.col("estArrivalAirport").isNotNull()).withColumn(
        "airport_icao", F.upper("estArrivalAirport")).withColumn("direction", F.lit("arrival"))
    root = scratch_path(spark, "directional")
    landing.write_flight_arrays(dep.unionByName(arr), root, extra_partitions=["airport_icao", "direction"])
    return payload.read_directional_flights(spark, root)


@query("delay_payload")
def q_delay_payload(spark, sf_dir):
    """Hourly airport-delay payloads (window ``from``/``to`` in UTC and local text), read back."""
    base = staging.departures_base(raw(spark, sf_dir, "raw_departures"))
    start = F.date_trunc("hour", F.col("departure_scheduled_utc")).cast("timestamp_ntz")
    hourly = base.groupBy(F.col("airport_icao"), start.alias("h")).agg(
        F.count_if(F.col("departure_runway_utc").isNotNull()).alias("numDeparted"),
        F.count_if(F.col("departure_runway_utc") > F.col("departure_scheduled_utc") + F.expr("INTERVAL 15 MINUTES"))
        .alias("numDelayed"))
    end = F.col("h") + F.expr("INTERVAL 59 MINUTES")
    doc = hourly.select(
        F.col("airport_icao").alias("airportIcao"),
        F.struct(F.concat(F.date_format("h", "yyyy-MM-dd HH:mm"), F.lit("Z")).alias("utc"),
                 F.concat(F.date_format(F.col("h") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm"),
                          F.lit("+01:00")).alias("local")).alias("from"),
        F.struct(F.concat(F.date_format(end, "yyyy-MM-dd HH:mm"), F.lit("Z")).alias("utc"),
                 F.concat(F.date_format(end + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm"),
                          F.lit("+01:00")).alias("local")).alias("to"),
        "numDeparted", "numDelayed")
    root = scratch_path(spark, "delays")
    doc.write.mode("overwrite").json(root)
    return payload.read_delay_payloads(spark, root)
