"""Local-calendar moments. Instants are zone-less UTC timestamps, so the session zone never matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Australia/Sydney"
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def local_time(utc: Column, zone: str = ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_date(utc: Column, zone: str = ZONE) -> Column:
    return F.to_date(local_time(utc, zone))


def utc_offset(utc: Column, zone: str = ZONE) -> Column:
    """``+10:00`` or ``+11:00``: the zone's offset at that instant."""
    minutes = F.timestamp_diff("MINUTE", utc, local_time(utc, zone))
    size = F.abs(minutes)
    return F.format_string(
        "%s%02d:%02d", F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+")), F.floor(size / 60), size % 60
    )


def iso_seconds(utc: Column) -> Column:
    return F.concat(F.replace(F.left(utc.cast("string"), F.lit(19)), F.lit(" "), F.lit("T")), F.lit("Z"))


def arrive_by_moment(utc_now: Column, weekday: str, at: str, zone: str = ZONE, standard_hours: int = 10) -> Column:
    """The next ``weekday`` at ``at`` local time, at least two days out, as text with its own offset."""
    if weekday not in WEEKDAYS:
        raise ValueError(f"unknown weekday {weekday!r}")
    day = F.next_day(F.date_add(local_date(utc_now, zone), 1), weekday)
    hour, minute = (int(part) for part in at.split(":"))
    # Standard-time guess of the instant: enough to land on the right side of a daylight-saving change.
    guess = F.timestamp_add(
        "MINUTE", F.lit((hour - standard_hours) * 60 + minute), day.cast("timestamp_ntz")
    )
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f"T{at}:00"), utc_offset(guess, zone))


def probe_moment(given_utc: Column, utc_now: Column, zone: str = ZONE) -> Column:
    """The given instant, else the first whole hour, two days or more away, that is 9 in the morning of a local weekday."""
    later = F.timestamp_add("DAY", F.lit(2), utc_now)
    earliest = F.make_timestamp_ntz(
        F.year(later), F.month(later), F.day(later), F.hour(later), F.lit(0), F.lit(0)
    )

    def nine(day: Column) -> Column:
        moment = F.convert_timezone(
            F.lit(zone), F.lit("UTC"), F.timestamp_add("HOUR", F.lit(9), day.cast("timestamp_ntz"))
        )
        # A zone off the whole hour reaches its first whole UTC hour later.
        return F.timestamp_add("MINUTE", F.pmod(-F.minute(moment), F.lit(60)), moment)

    # From any day a weekday morning is at most three days off.
    days = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.date_add(local_date(earliest, zone), i))
    weekdays = F.filter(days, lambda day: ~F.dayofweek(day).isin(1, 7))
    moments = F.filter(F.transform(weekdays, nine), lambda moment: moment >= earliest)
    return F.coalesce(given_utc, F.get(moments, F.lit(0)))


def run_id_candidates(utc_now: Column, zone: str = ZONE) -> Column:
    """The 26 ids a local day offers, in the order they are handed out."""
    day = F.date_format(local_date(utc_now, zone), "yyyy-MM-dd")
    letters = F.array(*[F.lit(chr(97 + i)) for i in range(26)])
    return F.transform(letters, lambda letter: F.concat(day, letter))
