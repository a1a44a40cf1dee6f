"""Further registered queries: data checks, single operators, readers, store, plan, KPIs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from aerostage.functions import casts, flags, predicates as P, text
from aerostage.operators.dedup import asc, desc, keep_first, rank_within
from aerostage.operators.surrogate import global_row_number
from aerostage.plans import checks, staging
from aerostage.plans.catalog import AIRPORTS_LOADED_AT, arr_base, dep_base, query, raw
from aerostage.session import materialize


# ---- data checks Q1-Q7 ---------------------------------------------------------------------
@query("checks_departures")
def q_checks_departures(spark, sf_dir):
    """All declared checks of the four departure models (the base is materialised once, shared by all)."""
    base = materialize(dep_base(spark, sf_dir), "stg_departures_base")
    return checks.run_all({
        "stg_departures_base": base,
        "stg_departures_not_departed": staging.departures_not_departed(base),
        "stg_departures_operator": staging.departures_operator(base),
        "stg_departures_unlinkable": staging.departures_unlinkable(base),
    })


@query("checks_arrivals")
def q_checks_arrivals(spark, sf_dir):
    """All declared checks of the four arrival models (the base is materialised once, shared by all)."""
    base = materialize(arr_base(spark, sf_dir), "stg_arrivals_base")
    return checks.run_all({
        "stg_arrivals_base": base,
        "stg_arrivals_not_arrived": staging.arrivals_not_arrived(base),
        "stg_arrivals_operator": staging.arrivals_operator(base),
        "stg_arrivals_unlinkable": staging.arrivals_unlinkable(base),
    })


@query("checks_airports")
def q_checks_airports(spark, sf_dir):
    """Declared checks of the airport dimension (key and code not null and unique)."""
    return checks.run_checks(staging.airports(raw(spark, sf_dir, "raw_airports"), AIRPORTS_LOADED_AT), "stg_airports")


@query("checks_flights")
def q_checks_flights(spark, sf_dir):
    """Declared checks of the observed flights (identity not null and unique)."""
    return checks.run_checks(staging.flights(raw(spark, sf_dir, "raw_flights")), "stg_flights")


@query("checks_raw_constraints")
def q_checks_raw_constraints(spark, sf_dir):
    """Declared raw-table constraints (NOT NULL day and airport, the two primary keys) as checks."""
    return checks.run_all({name: raw(spark, sf_dir, name) for name in checks.RAW_CHECKS})


SCHEDULE_ROW = ["row_id", "flight_number", "flight_date", "callsign", "aircraft_mode_s", "airport_icao", "status", "codeshare_status"]


def _offending(models: dict, columns: list[str]):
    parts = [checks.offending_rows(df, name).select("model", "check_name", *columns) for name, df in models.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("offending_departures")
def q_offending_departures(spark, sf_dir):
    """Q1-Q7: every row of the four departure models that fails a check, once for each check."""
    base = materialize(dep_base(spark, sf_dir), "stg_departures_base")
    return _offending({
        "stg_departures_base": base,
        "stg_departures_not_departed": staging.departures_not_departed(base),
        "stg_departures_operator": staging.departures_operator(base),
        "stg_departures_unlinkable": staging.departures_unlinkable(base),
    }, SCHEDULE_ROW)


@query("offending_arrivals")
def q_offending_arrivals(spark, sf_dir):
    """Q1-Q7: every row of the four arrival models that fails a check, once for each check."""
    base = materialize(arr_base(spark, sf_dir), "stg_arrivals_base")
    return _offending({
        "stg_arrivals_base": base,
        "stg_arrivals_not_arrived": staging.arrivals_not_arrived(base),
        "stg_arrivals_operator": staging.arrivals_operator(base),
        "stg_arrivals_unlinkable": staging.arrivals_unlinkable(base),
    }, SCHEDULE_ROW)


@query("offending_airports")
def q_offending_airports(spark, sf_dir):
    """Q1, Q2: failing rows of the airport dimension."""
    stg = staging.airports(raw(spark, sf_dir, "raw_airports"), AIRPORTS_LOADED_AT)
    return _offending({"stg_airports": stg}, ["airport_key", "airport_icao"])


@query("offending_flights")
def q_offending_flights(spark, sf_dir):
    """Q1, Q5: failing rows of the observed flights."""
    return _offending({"stg_flights": staging.flights(raw(spark, sf_dir, "raw_flights"))}, ["row_id", "icao24", "first_seen_ts"])


@query("offending_raw_rows")
def q_offending_raw_rows(spark, sf_dir):
    """The raw tables' rows that break a declared constraint (null keys, repeated primary keys)."""
    return _offending({name: raw(spark, sf_dir, name).withColumn("row_id", F.col("row_id").cast("bigint")) for name in checks.RAW_CHECKS}, ["row_id"])


@query("duplicate_groups")
def q_duplicate_groups(spark, sf_dir):
    """A2: keys of the base departures that appear more than once under the declared unique key."""
    base = dep_base(spark, sf_dir)
    keys = ["flight_number", "flight_date", "airport_icao", "departure_scheduled_utc", "arrival_airport_icao",
            "arrival_scheduled_utc"]
    return base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


# ---- single operators: filters F1-F8 ---------------------------------------------------------


@query("filter_cargo")
def q_filter_cargo(spark, sf_dir):
    """raw departures that are not cargo (null cargo flag dropped)."""
    return raw(spark, sf_dir, "raw_departures").where(P.not_cargo("isCargo"))


@query("filter_same_day")
def q_filter_same_day(spark, sf_dir):
    """raw departures scheduled (UTC) on their flight date."""
    return raw(spark, sf_dir, "raw_departures").where(P.same_day("departure_scheduledtime_utc"))


@query("filter_operator")
def q_filter_operator(spark, sf_dir):
    """operator rows of the base departures."""
    return dep_base(spark, sf_dir).where(P.is_operator())


def _classes(spark, sf_dir, dep_pred, arr_pred):
    cols = ["row_id", "flight_date", "airport_icao", "status", "codeshare_status"]
    dep = dep_base(spark, sf_dir).where(dep_pred).select(F.lit("departure").alias("direction"), *cols)
    arr = arr_base(spark, sf_dir).where(arr_pred).select(F.lit("arrival").alias("direction"), *cols)
    return dep.unionByName(arr)


@query("filter_status")
def q_filter_status(spark, sf_dir):
    """F4 + F5: departed departures and arrived-class arrivals."""
    return _classes(spark, sf_dir, P.status_is(P.DEPARTED), P.status_in(P.ARRIVED_STATUSES))


@query("filter_status_not")
def q_filter_status_not(spark, sf_dir):
    """the complements; a null status is in neither side."""
    return _classes(spark, sf_dir, P.status_not(P.DEPARTED), P.status_not_in(P.ARRIVED_STATUSES))


@query("filter_identified")
def q_filter_identified(spark, sf_dir):
    """base departures with a callsign or a mode-S code."""
    return dep_base(spark, sf_dir).where(P.identified())


@query("filter_unidentified")
def q_filter_unidentified(spark, sf_dir):
    """F8: base departures with neither."""
    return dep_base(spark, sf_dir).where(P.unidentified())


# ---- single operators: scalar functions P3-P16 -----------------------------------------------
@query("text_clean")
def q_text_clean(spark, sf_dir):
    """P3 + P4: upper and trim on observed-flight and schedule text."""
    return raw(spark, sf_dir, "raw_flights").select(
        "row_id",
        text.upper("icao24").alias("icao24"),
        text.upper_trim("callsign").alias("callsign"),
        text.upper("estDepartureAirport").alias("est_departure_airport"),
        text.trim(F.concat(F.lit("  "), F.col("callsign"))).alias("callsign_trimmed"),
    )


@query("safe_casts")
def q_safe_casts(spark, sf_dir):
    """Text to double, number and date; failures give null."""
    fl = raw(spark, sf_dir, "raw_flights").select(
        F.lit("flights").alias("source"), "row_id",
        casts.try_long("estDepartureAirportHorizDistance").alias("as_number"),
        casts.try_date("record_date").alias("as_date"),
    )
    ap = raw(spark, sf_dir, "raw_airports").select(
        F.lit("airports").alias("source"), F.col("row_id").cast("bigint").alias("row_id"),
        casts.try_double_text("elevation_ft").alias("as_double"),
        casts.try_double_text("latitude").alias("latitude"),
    )
    return fl.unionByName(ap, allowMissingColumns=True)


@query("epoch_time")
def q_epoch_time(spark, sf_dir):
    """P8 + P9: epoch seconds to UTC timestamp, and timestamp to date."""
    return raw(spark, sf_dir, "raw_flights").select(
        "row_id",
        casts.epoch_to_timestamp("firstSeen").alias("first_seen_ts"),
        casts.epoch_to_timestamp("lastSeen").alias("last_seen_ts"),
        F.to_date(casts.epoch_to_timestamp("firstSeen")).alias("first_seen_date"),
    )


@query("airline_fallback")
def q_airline_fallback(spark, sf_dir):
    """P12 + P13 on every raw departure."""
    r = raw(spark, sf_dir, "raw_departures")
    return r.select(
        "row_id", F.col("number").alias("flight_number"), text.upper("callSign").alias("callsign"),
        text.airline_iata_fallback("airline_iata", "number").alias("airline_iata"),
        text.airline_icao_fallback("airline_icao", text.upper("callSign")).alias("airline_icao"),
    )


@query("reliability_score")
def q_reliability_score(spark, sf_dir):
    """P14 on the base arrivals."""
    return arr_base(spark, sf_dir).select("row_id", flags.reliability_score().alias("reliability_score"))


@query("completeness_flag")
def q_completeness_flag(spark, sf_dir):
    """P15 (as deployed, and the strict reading of its comment) on renamed departures."""
    return staging.departures_filtered(raw(spark, sf_dir, "raw_departures")).select(
        "row_id", flags.completeness_flag().alias("completeness_flag"),
        flags.completeness_flag(strict=True).alias("strict_flag"),
    )


# ---- single operators: windows W1-W8 ----------------------------------------------------------
@query("latest_flight")
def q_latest_flight(spark, sf_dir):
    """Newest load of each (icao24, first seen) on the raw observed flights."""
    r = raw(spark, sf_dir, "raw_flights").select(
        "row_id", "icao24", casts.epoch_to_timestamp("firstSeen").alias("first_seen_ts"), "ingestion_timestamp")
    return keep_first(r, ["icao24", "first_seen_ts"], [desc("ingestion_timestamp")])


@query("airport_key")
def q_airport_key(spark, sf_dir):
    """Global surrogate numbering by ICAO code without a one-task window."""
    r = raw(spark, sf_dir, "raw_airports").select("row_id", "icao")
    return global_row_number(r, [asc("icao"), asc("row_id")], name="airport_key")


@query("latest_arrival")
def q_latest_arrival(spark, sf_dir):
    """W4 (= the arrivals base model)."""
    return arr_base(spark, sf_dir).select("row_id", *staging.ARRIVAL_IDENTITY, "ingestion_timestamp")


@query("latest_departure")
def q_latest_departure(spark, sf_dir):
    """Newest record of each full departure identity."""
    f = staging.departures_filtered(raw(spark, sf_dir, "raw_departures"))
    return keep_first(f, staging.DEPARTURE_IDENTITY, [desc("ingestion_timestamp")]).select(
        "row_id", *staging.DEPARTURE_IDENTITY, "ingestion_timestamp")


@query("most_complete")
def q_most_complete(spark, sf_dir):
    """The most complete record of each flight (after W5)."""
    return dep_base(spark, sf_dir).select("row_id", *staging.DEPARTURE_FLIGHT,
                                          flags.completeness_flag().alias("completeness_flag"))


def _pair_ranks(df, order, name="pair_rank"):
    return rank_within(df, staging.PAIR_KEYS, order, name=name).where(F.col(name) <= 2)


@query("pair_rank")
def q_pair_rank(spark, sf_dir):
    """Rank 1 and 2 of the departed operator rows by scheduled time."""
    rows = dep_base(spark, sf_dir).where(P.status_is(P.DEPARTED) & P.is_operator() & P.identified())
    return _pair_ranks(rows, [asc("departure_scheduled_utc")]).select(
        "row_id", *staging.PAIR_KEYS, "departure_scheduled_utc", "pair_rank")


@query("pair_rank_scored")
def q_pair_rank_scored(spark, sf_dir):
    """Rank 1 and 2 of the arrived operator rows by reliability."""
    rows = arr_base(spark, sf_dir).where(P.status_in(P.ARRIVED_STATUSES) & P.identified() & P.is_operator())
    rows = rows.withColumn("reliability_score", flags.reliability_score())
    return _pair_ranks(rows, [desc("reliability_score")]).select(
        "row_id", *staging.PAIR_KEYS, "reliability_score", "pair_rank")


@query("pair_merge_departures")
def q_pair_merge_departures(spark, sf_dir):
    """J1 as one aggregation of each group's first two records (compare with ``departures_operator``)."""
    return staging.departures_operator_grouped(dep_base(spark, sf_dir))


@query("pair_merge_arrivals")
def q_pair_merge_arrivals(spark, sf_dir):
    """J2 through the window form."""
    return staging.arrivals_operator(arr_base(spark, sf_dir))


# ---- airport selection A1, F9 -----------------------------------------------------------------
@query("airport_codes")
def q_airport_codes(spark, sf_dir):
    """A1: distinct ICAO codes of the raw airport list."""
    return raw(spark, sf_dir, "raw_airports").select("icao").distinct()


@query("airports_by_country")
def q_airports_by_country(spark, sf_dir):
    """ICAO codes of the airports in the load countries (no DISTINCT, as the load requests them)."""
    return raw(spark, sf_dir, "raw_airports").where(P.country_in()).select("icao")


def _time_texts(spark, sf_dir):
    """Departure revised times written as text in six layouts (``T``/blank, seconds or not,
    ``Z``/offset/none, junk), chosen by the row id."""
    r = raw(spark, sf_dir, "raw_departures")
    utc, local = F.col("departure_revisedtime_utc"), F.col("departure_revisedtime_local")
    layout = F.pmod(F.col("row_id"), F.lit(6)).cast("int")
    minus_530 = utc - F.expr("INTERVAL '5:30' HOUR TO MINUTE")
    utc_text = (F.when(layout == 0, F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm"), F.lit("Z")))
                .when(layout == 1, F.concat(F.date_format(local, "yyyy-MM-dd HH:mm"), F.lit("+01:00")))
                .when(layout == 2, F.concat(F.date_format(minus_530, "yyyy-MM-dd HH:mm:ss"), F.lit("-05:30")))
                .when(layout == 3, F.date_format(utc, "yyyy-MM-dd HH:mm"))
                .when(layout == 4, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"))
                .otherwise(F.concat(F.lit("at "), F.date_format(utc, "yyyy-MM-dd HH:mm"))))
    local_text = F.when(layout == 5, F.lit("n/a")).otherwise(
        F.concat(F.date_format(local, "yyyy-MM-dd HH:mm"), F.lit("+01:00")))
    return r.select("row_id", layout.alias("layout"), utc_text.alias("utc_text"), local_text.alias("local_text"))


@query("parse_times")
def q_parse_times(spark, sf_dir):
    """The six layouts parsed back to UTC and local wall-clock times."""
    return _time_texts(spark, sf_dir).select("row_id", "layout",
                                             casts.parse_utc_time("utc_text").alias("parsed_utc"),
                                             casts.parse_local_time("local_text").alias("parsed_local"))


@query("time_parse_report")
def q_time_parse_report(spark, sf_dir):
    """P16 report: per time column, the texts seen and how many parsed to null."""
    parsed = _time_texts(spark, sf_dir).select(
        "utc_text", "local_text", casts.parse_utc_time("utc_text").alias("u"),
        casts.parse_local_time("local_text").alias("l"))
    return casts.unparsed_report(parsed, {"departure_revisedtime_utc": ("utc_text", "u"),
                                          "departure_revisedtime_local": ("local_text", "l")})
