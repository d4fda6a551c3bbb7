"""Mixed timestamp notations and zones to one unambiguous form."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta
from importlib import resources
from zoneinfo import TZPATH, ZoneInfo, available_timezones

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fold, squeeze
from ..session import packed, unpacked

# Month names without accents; the place in the list is the month.
MONTHS = [
    "ocak january januar janvier jan",
    "subat february februar fevrier feb fevr",
    "mart march marz mars mar maerz",
    "nisan april avril apr avr",
    "mayis may mai",
    "haziran june juni juin jun",
    "temmuz july juli juillet jul juil",
    "agustos august aout aug",
    "eylul september septembre sep sept",
    "ekim october oktober octobre oct okt",
    "kasim november novembre nov",
    "aralik december dezember decembre dec dez",
]
# Weekdays without accents, Monday first.
WEEKDAYS = [
    "pazartesi monday montag lundi mon mo",
    "sali tuesday dienstag mardi tue di",
    "carsamba wednesday mittwoch mercredi wed mi",
    "persembe thursday donnerstag jeudi thu do",
    "cuma friday freitag vendredi fri fr",
    "cumartesi saturday samstag samedi sat sa",
    "pazar sunday sonntag dimanche sun so",
]
# Zone abbreviations with one common meaning, in minutes.
OFFSETS = {"z": 0, "utc": 0, "gmt": 0, "wet": 0, "bst": 60, "west": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180, "trt": 180, "msk": 180, "jst": 540, "est": -300, "edt": -240, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420}
#: years of the table of offsets, and how many of them share a row. No zone changed before FIRST; from LAST on, a year has
#: the offsets of an earlier one with the same calendar, as the rules for all later years name weekdays of months
FIRST, LAST, BLOCK = 1832, 2191, 8
ZONE = "(z|[a-z]{3,4}|(?:utc|gmt)?[+-]\\d{1,2}(?::?\\d{2})?|[a-z]+/[a-z_]+(?:/[a-z_]+)?)"
TIME = "(\\d{1,2})[:.h](\\d{2})(?::(\\d{2})(?:[.,]\\d+)?)?"

# Notations over folded text without weekday; names say which group holds what.
NOTATIONS = {
    "iso": (f"^(\\d{{4}})[-/.](\\d{{1,2}})[-/.](\\d{{1,2}})(?:(?:t|,? )(\\d{{1,2}}):(\\d{{2}})(?::(\\d{{2}})(?:[.,]\\d+)?)? ?{ZONE}?)?$", "y m d H M S z"),
    "basic": (f"^(\\d{{4}})(\\d{{2}})(\\d{{2}})(?:t(\\d{{2}})(\\d{{2}})(?:(\\d{{2}})(?:[.,]\\d+)?)? ?{ZONE}?)?$", "y m d H M S z"),
    "numeric": (f"^(\\d{{1,2}})[./-](\\d{{1,2}})[./-](\\d{{4}}|\\d{{2}})(?:(?:,? -? ?|t){TIME} ?(am|pm)? ?{ZONE}?)?$", "a b y H M S p z"),
    "day_name": (f"^(\\d{{1,2}})(?:st|nd|rd|th|er)?\\.? (?:of )?([a-z]{{3,}})\\.?,? (\\d{{4}})(?:,? (?:saat |a |um |at )?{TIME}(?: uhr)? ?(am|pm)? ?{ZONE}?)?$", "d n y H M S p z"),
    "name_day": (f"^([a-z]{{3,}})\\.? (\\d{{1,2}})(?:st|nd|rd|th)?,? (\\d{{4}})(?:,? (?:at )?{TIME} ?(am|pm)? ?{ZONE}?)?$", "n d y H M S p z"),
}


def _recorded(name: str) -> list[tuple[int, int]] | None:
    """(instant, offset from then on) of a zone's recorded changes, out of the public tz files; None if these are not at hand."""
    for folder in TZPATH:
        path = os.path.join(folder, name)
        if os.path.isfile(path):
            with open(path, "rb") as f:
                data = f.read()
            break
    else:
        try:
            data = resources.files("tzdata.zoneinfo").joinpath(name).read_bytes()
        except (ModuleNotFoundError, FileNotFoundError):
            return None
    counts = lambda at: struct.unpack(">6l", data[at + 20 : at + 44])
    if data[:4] != b"TZif" or data[4:5] < b"2":
        return None
    utc, std, leap, times, types, chars = counts(0)
    at = 44 + times * 5 + types * 6 + chars + leap * 8 + std + utc
    _, _, _, times, types, _ = counts(at)
    at += 44
    when = struct.unpack(f">{times}q", data[at : at + 8 * times])
    kind = data[at + 8 * times : at + 9 * times]
    offsets = [struct.unpack(">l", data[at + 9 * times + 6 * k : at + 9 * times + 6 * k + 4])[0] for k in range(types)]
    return [(t, offsets[k]) for t, k in zip(when, kind, strict=True)]


def _intervals(names: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spans of constant offset of each zone, one row per zone and local block of years: recorded changes first, then those that its rule for all later years makes, by monthly samples and bisection."""
    second = lambda y: int(datetime(y, 1, 1, tzinfo=UTC).timestamp())
    for part in names:
        out = []
        for name in part["name"]:
            zone = ZoneInfo(name)
            off = lambda t, z=zone: int(datetime.fromtimestamp(t, UTC).astimezone(z).utcoffset() // timedelta(seconds=1))
            changes = _recorded(name)
            step = 30 * 86400
            if changes is None:
                changes, step = [], 7 * 86400
            spans, begin, now = [], -(1 << 40), off(second(FIRST))
            for t, o in changes:
                if o != now and t >= second(FIRST):
                    spans.append((begin, t, now))
                    begin, now = t, o
            start = max([second(FIRST), *(t for t, _ in changes)])
            if step < 30 * 86400 or len({off(second(LAST - 1) + k * step) for k in range(13)}) > 1:
                for t in range(start, second(LAST + 1), step):
                    if (new := off(t + step)) != now:
                        a, b = t, t + step
                        while b - a > 1:
                            mid = (a + b) // 2
                            a, b = (mid, b) if off(mid) == now else (a, mid)
                        spans.append((begin, b, now))
                        begin, now = b, new
            spans.append((begin, 1 << 40, now))
            for year in range(FIRST, LAST + 1, BLOCK):
                a, b = (second(y) if FIRST < y <= LAST else (-(1 << 40) if y <= FIRST else 1 << 40) for y in (year, year + BLOCK))
                near = [{"since": s + o, "until": e + o, "offset": o} for s, e, o in spans if e + o > a and s + o < b]
                out.append((name.lower(), year, near))
        yield pd.DataFrame(out, columns=["zone", "year", "spans"])


def zone_intervals(spark: SparkSession, zones: list[str]) -> DataFrame:
    """(zone, year, spans): for each zone its local-time spans of constant UTC offset, per block of local years; zone in lower case."""
    names = spark.createDataFrame([(z,) for z in zones], "name string").repartition(8)
    return names.mapInPandas(_intervals, "zone string, year int, spans array<struct<since:bigint,until:bigint,offset:bigint>>")


def _lookup(words: list[str], key: Column) -> Column:
    pairs = [F.lit(x) for i, names in enumerate(words) for n in names.split() for x in (n, i + 1)]
    return F.try_element_at(F.create_map(*pairs), key)


ORDER = "y m d n a b H M S p z".split()


def taken_apart(text: Column) -> Column:
    """struct(s, week, p): the folded text without weekday, the weekday, and the pieces of the first notation that fits
    the whole text, its name first and then those of ORDER (null if none fits). One regular expression a notation."""
    s = F.regexp_replace(fold(squeeze(text)), "^[\"']+|[\"']+$", "")
    names = "|".join(sorted((n for w in WEEKDAYS for n in w.split()), key=len, reverse=True))
    lead = f"^({names})\\.?,? (?=\\d|[a-z])"
    bare = F.regexp_replace(s, lead, "")
    chain = None
    for name, (pattern, groups) in NOTATIONS.items():
        at = {g: f"${i + 1}" for i, g in enumerate(groups.split())}
        got = F.regexp_replace(bare, pattern, "|".join([name, *(at.get(g, "") for g in ORDER)]))
        chain = F.when(bare.rlike(pattern), got) if chain is None else chain.when(bare.rlike(pattern), got)
    return F.struct(bare.alias("s"), F.regexp_extract(s, lead, 1).alias("week"), F.split(chain, "\\|").alias("p"))


def _calendars() -> dict[int, int]:
    """A late year of the table for each kind of calendar: the weekday of its first day, plus seven for a leap year."""
    return {date(y, 1, 1).weekday() + (7 if date(y, 12, 31).timetuple().tm_yday == 366 else 0): y for y in range(LAST - 27, LAST + 1)}


def normalised(df: DataFrame, text: str, zone: Column, order: Column) -> DataFrame:
    """df with (normal, status): a UTC instant `YYYY-MM-DDThh:mm:ssZ` or a day `YYYY-MM-DD`.

    order (`DMY`, `MDY` or null) settles all-numeric dates that could be read both ways; null leaves those unread.
    Texts of any length and years of 1 to 9999 are read. zone: the zone of times without one, an IANA name or minutes east of UTC as text, or null. status: `ok`,
    `ambiguous` (a local time that happens twice), `nonexistent` (one that is skipped), `no_zone`, `unread` (not one
    full real date: partial, relative, impossible, missing), in which case normal is null. Null and empty
    texts are `unread`. Other columns stay as they are, whatever
    their names; ones named like a result give way to it. No row is shuffled: the offset spans
    are looked up as of the local time in a table of zone and year.
    """
    num = lambda c: F.when(c != "", c).cast("int")
    x = packed(df, _t=F.col(text), _zone=zone, _order=order)
    x = x.withColumn("_r", taken_apart(F.col("_t")))
    s = F.col("_r.s")
    p = {g: F.col("_r.p")[i] for i, g in enumerate(["via", *ORDER])}
    a, b = num(p["a"]), num(p["b"])
    day_first = F.when(a > 12, True).when(b > 12, False).when(a == b, True).when(F.col("_order") == "DMY", True).when(F.col("_order") == "MDY", False)
    year = num(p["y"])
    year = F.when(F.length(p["y"]) == 2, year + 2000).otherwise(year)
    numeric = p["via"] == "numeric"
    x = x.withColumn("_y", year).withColumn("_m", F.when(numeric, F.when(day_first, b).otherwise(F.when(~day_first, a))).when(p["n"] != "", _lookup(MONTHS, p["n"])).otherwise(num(p["m"]))).withColumn("_d", F.when(numeric, F.when(day_first, a).otherwise(F.when(~day_first, b))).otherwise(num(p["d"])))
    hour = num(p["H"])
    h12 = hour.between(1, 12)
    hour = F.when(p["p"] == "pm", F.when(h12, hour % 12 + 12)).when(p["p"] == "am", F.when(h12, hour % 12)).otherwise(hour)
    timed = p["H"] != ""
    x = x.withColumn("_timed", timed).withColumn("_h", F.when(timed, hour)).withColumn("_mi", F.when(timed, num(p["M"]))).withColumn("_s", F.when(timed, F.coalesce(num(p["S"]), F.lit(0))))
    leap = (F.col("_y") % 4 == 0) & ((F.col("_y") % 100 != 0) | (F.col("_y") % 400 == 0))
    most = F.when(F.col("_m").isin(4, 6, 9, 11), 30).when(F.col("_m") == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    real = F.col("_y").between(1, 9999) & F.col("_m").between(1, 12) & (F.col("_d") >= 1) & (F.col("_d") <= most)
    real = real & (~F.col("_timed") | (F.col("_h").between(0, 23) & F.col("_mi").between(0, 59) & F.col("_s").between(0, 59)))
    days = F.unix_date(F.make_date("_y", "_m", "_d"))
    # a week date names its day by year, week and weekday
    wy, ww, wd = (F.regexp_extract(s, "^(\\d{4})-?w(\\d{2})-?([1-7])$", i) for i in (1, 2, 3))
    is_week = s.rlike("^\\d{4}-?w\\d{2}-?[1-7]$")
    jan4 = F.make_date(num(wy), F.lit(1), F.lit(4))
    monday = F.unix_date(jan4) - F.weekday(jan4)
    by_week = monday + (num(ww) - 1) * 7 + num(wd) - 1
    thursday = F.date_from_unix_date(monday + (num(ww) - 1) * 7 + 3)
    good_week = (num(wy) >= 1) & num(ww).between(1, 53) & (F.year(thursday) == num(wy))
    serial = F.when(s.rlike("^[2-6]\\d{4}$"), s.cast("int") - 25569)  # spreadsheet days since 1899-12-30
    x = x.withColumn("_days", F.when(F.coalesce(real, F.lit(False)), days).when(is_week, F.when(good_week, by_week)).otherwise(serial))
    week = F.col("_r.week")
    fits = (week == "") | (F.weekday(F.date_from_unix_date("_days")) + 1 == _lookup(WEEKDAYS, week))
    epoch = F.when(s.rlike("^\\d{10}$"), s.cast("long")).when(s.rlike("^\\d{13}$"), F.floor(s.cast("long") / 1000).cast("long"))
    z = p["z"]
    signed = F.regexp_extract(z, "^(?:utc|gmt)?([+-])(\\d{1,2}):?(\\d{2})?$", 1)
    hh, mm = (num(F.regexp_extract(z, "^(?:utc|gmt)?([+-])(\\d{1,2}):?(\\d{2})?$", i)) for i in (2, 3))
    given = F.when(signed != "", F.when(signed == "-", -1).otherwise(1) * (hh * 60 + F.coalesce(mm, F.lit(0)))).otherwise(F.try_element_at(F.create_map(*(F.lit(v) for kv in OFFSETS.items() for v in kv)), z))
    named = F.when(z.contains("/"), z)
    x = x.withColumn("_days", F.when(fits, F.col("_days"))).withColumn("_local", F.when(F.col("_timed"), F.col("_days").cast("long") * 86400 + F.col("_h") * 3600 + F.col("_mi") * 60 + F.col("_s")))
    own = F.col("_zone").rlike("^[+-]?\\d+$")
    minutes = F.when(z != "", given).when(own, F.col("_zone").cast("int"))
    x = x.withColumn("_epoch", epoch).withColumn("_minutes", F.when(named.isNull(), minutes)).withColumn("_named", F.lower(F.when(named.isNotNull(), named).when((z == "") & ~own, F.col("_zone"))))
    x = x.withColumn("_lookup", F.when(F.col("_local").isNotNull() & F.col("_minutes").isNull(), F.col("_named")))
    year = F.year(F.date_from_unix_date("_days"))
    new_year = F.unix_date(F.make_date(year, F.lit(1), F.lit(1)))
    alike = F.try_element_at(F.create_map(*(F.lit(v) for kv in _calendars().items() for v in kv)), F.weekday(F.date_from_unix_date(new_year)) + F.when(F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366, 7).otherwise(0))
    moved = F.when(year > LAST, F.unix_date(F.make_date(alike, F.lit(1), F.lit(1))) - new_year).otherwise(0)  # days
    x = x.withColumn("_like", F.col("_local") + moved.cast("long") * 86400)
    block = F.greatest(F.when(year > LAST, alike).otherwise(year), F.lit(FIRST))
    x = x.withColumn("_block", block - (block - FIRST) % BLOCK)
    spark = df.sparkSession
    # all zones of the public tz database: a list of fixed size
    every = [n for n in sorted(available_timezones()) if "/" in n and not n.startswith(("Etc/", "SystemV/", "posix/", "right/")) or n == "UTC"]
    spans = zone_intervals(spark, every).withColumnsRenamed({"zone": "_zk", "year": "_zy", "spans": "_spans"})
    x = x.join(F.broadcast(spans), (F.col("_lookup") == F.col("_zk")) & (F.col("_block") == F.col("_zy")), "left")
    x = x.withColumn("_at", F.filter("_spans", lambda v: (F.col("_like") >= v["since"]) & (F.col("_like") < v["until"])))
    n = F.size("_at")
    utc = F.coalesce(F.col("_epoch"), F.col("_local") - F.col("_minutes") * 60, F.when(n == 1, F.col("_local") - F.col("_at")[0]["offset"]))
    day = F.when(~F.coalesce(F.col("_timed"), F.lit(False)) & F.col("_epoch").isNull(), F.col("_days"))
    x = x.withColumn("_utc", utc).withColumn("_day", day)
    part = lambda per, size: F.lpad(F.floor(F.pmod(F.col("_utc"), F.lit(per)) / size).cast("string"), 2, "0")
    instant = F.concat(F.date_from_unix_date(F.floor(F.col("_utc") / 86400).cast("int")).cast("string"), F.lit("T"), part(86400, 3600), F.lit(":"), part(3600, 60), F.lit(":"), part(60, 1), F.lit("Z"))
    status = F.when(F.col("_utc").isNotNull() | F.col("_day").isNotNull(), "ok").when(F.col("_local").isNull(), "unread").when(F.col("_spans").isNull(), "no_zone").when(n > 1, "ambiguous").otherwise("nonexistent")
    # a generator: filters on the outcome stay above it
    return x.select(*unpacked(x, df, "normal", "status"), F.inline(F.array(F.struct(F.coalesce(instant, F.date_from_unix_date("_day").cast("string")).alias("normal"), status.alias("status")))))
