"""Expressions that turn raw event fields into clean ones."""

from pyspark.sql import functions as F

from cartwright import schema


def is_known_event(event_type="event_type"):
    return F.col(event_type).isin(*schema.EVENT_TYPES)


def present_text(column):
    """Null where the cell holds one of the spellings of "no value"."""
    return F.when(~F.col(column).isin(*schema.MISSING_TEXT), F.col(column))


def filled_price(price="price"):
    """0.0 for a missing price, whether it arrives as null or as NaN."""
    return F.coalesce(F.nanvl(F.col(price), F.lit(0.0)), F.lit(0.0))


def plain_text(column):
    """Trimmed lower case, `unknown` where there is no value; an empty string stays empty."""
    return F.coalesce(F.lower(F.trim(F.col(column))), F.lit("unknown"))


def event_instant(event_time="event_time"):
    """Instant of `yyyy-MM-dd HH:mm:ss UTC`, null for any other text.

    The zone is read from the text, so the instant does not depend on the session time zone.
    """
    text = F.col(event_time)
    return F.when(text.endswith(" UTC"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss z")))


def moment(as_of=None):
    """The processing instant: the query's clock, or a given datetime when a run must be repeatable."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def iso_text(instant):
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def slug(column):
    """`a.b.c` as the folder name `a_b_c`."""
    return F.translate(F.col(column), ".", "_")
