"""Time texts as the feed sends them are parsed by position; every other text by the long way, with the same results."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from aerostage.functions import casts

SENT = {"2024-01-31 23:59Z": (dt.datetime(2024, 1, 31, 23, 59), "u"), "2024-01-31 23:59+05:30": (dt.datetime(2024, 1, 31, 23, 59), "l"),
        "2024-01-31 00:00-11:00": (dt.datetime(2024, 1, 31), "l"), "2024-02-30 10:00Z": (None, "u"), "2024-01-31 24:00+01:00": (None, "l")}


def test_texts_as_sent_need_no_clean_up(spark, monkeypatch):
    monkeypatch.setattr(casts, "_normalised", lambda c: F.raise_error(F.lit("cleaned")).cast("string"))
    df = spark.createDataFrame([(t,) for t in SENT], "t string")
    for parse, kind in ((casts.parse_utc_time, "u"), (casts.parse_local_time, "l")):
        rows = df.where(F.col("t").endswith("Z") == F.lit(kind == "u")).select("t", parse("t").alias("x")).collect()
        assert {r.t: r.x for r in rows} == {t: x for t, (x, k) in SENT.items() if k == kind}


PATTERN = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2}) ([0-9]{2}):([0-9]{2})(?::([0-9]{2})(?:\.([0-9]{1,9}))?)?(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?")


def plain(text: str):
    """(matches, UTC, local) of one text, in plain Python."""
    m = PATTERN.fullmatch(text.strip(" ").replace("T", " "))
    if not m:
        return False, None, None
    try:
        local = dt.datetime(*[int(x) for x in m.groups("0")[:6]], int((m[7] or "").ljust(6, "0")[:6]))
    except ValueError:
        return True, None, None
    zone = (m[8] or "Z").replace(":", "")
    if zone == "Z":
        return True, local, local
    hours, minutes = int(zone[1:3]), int(zone[3:] or "0")
    shift = (hours * 60 + minutes) * (-1 if zone[0] == "-" else 1)
    return True, local - dt.timedelta(minutes=shift) if minutes < 60 and abs(shift) <= 18 * 60 else None, local


def test_changed_texts_against_plain_python(spark):
    rng = random.Random(7)
    base = [*SENT, "2024-01-01T10:00Z", " 2024-01-01 10:00Z ", "2024-01-01 10:00:05.123Z", "2024-01-01 10:00", "2024-01-01 10:00+0130"]
    texts = set(base)
    while len(texts) < 4000:
        s = list(rng.choice(base))
        for _ in range(rng.choice((1, 1, 2))):
            i = rng.randrange(len(s))
            s[i:i + rng.randrange(2)] = rng.choice(["", *"T0:159-+Z. \t١é"])
        texts.add("".join(s))
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    matched = 0
    both = df.select("t", casts.parse_utc_time("t").alias("u"), casts.parse_local_time("t").alias("l"))
    for r in both.withColumn("l", F.when(F.year("l").between(1, 9999), F.col("l"))).collect():  # else no Python date
        known, utc, local = plain(r.t)
        matched += known
        assert r.u == utc, r.t
        assert not known or r.l == local, r.t
    assert matched > 100
