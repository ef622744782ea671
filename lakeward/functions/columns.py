"""Column expressions shared by every layer and report.

All of these return JVM-side ``Column`` expressions, so they stay inside
whole-stage codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeward.config import MONEY_TYPE

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cast_or_raise(c: Column, type_name: str, what: str) -> Column:
    """A cast that raises on values it can't convert, whatever the session's ANSI mode."""
    told = F.concat(F.lit(f"not a {what}: "), c.cast("string"))
    return F.coalesce(c.try_cast(type_name), F.when(c.isNotNull(), F.raise_error(told)).cast(type_name))


def as_decimal_money(c: ColumnOrName, money_type: str = MONEY_TYPE) -> Column:
    """Fixed-point money. Strings are parsed exactly (no float detour);
    a malformed value or an overflow raises."""
    return _cast_or_raise(_col(c), money_type, money_type)


#: The end of timestamp text that names an offset or a zone.
RE_ZONED = r"[0-9]\s*(Z|UTC|[+-][0-9]{1,2}(:?[0-9]{2})?)\s*$"


def to_wall_clock(c: ColumnOrName) -> Column:
    """Parse text to a zone-less wall-clock timestamp; malformed text raises.

    Text without an offset is taken as it stands; text with one (``+02:00``), of which
    a direct cast would drop the offset, gives the wall clock of UTC. Neither
    depends on the session's zone."""
    c = _col(c)
    secs = (F.unix_micros(_cast_or_raise(c, "timestamp", "timestamp")).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    zoned = (F.length(c) > 16) & F.contains(c, F.lit(":")) & c.rlike(RE_ZONED)
    return F.when(zoned, utc).otherwise(_cast_or_raise(c, "timestamp_ntz", "timestamp"))


def to_date(c: ColumnOrName) -> Column:
    return _col(c).cast("date")


def lower(c: ColumnOrName) -> Column:
    return F.lower(_col(c))


def decimal_literal(value: int | str = 0, money_type: str = MONEY_TYPE) -> Column:
    return F.lit(value).cast(money_type)


def coalesce_zero(c: ColumnOrName, type_name: str = MONEY_TYPE) -> Column:
    """``coalesce(c, 0)`` with a zero of the given type."""
    return F.coalesce(_col(c), F.lit(0).cast(type_name))


def lag_minutes(source: ColumnOrName, layer: ColumnOrName) -> Column:
    """Whole minutes from ``layer`` to ``source``, floored (-1 s gives -1)."""
    micros = F.timestamp_diff("MICROSECOND", _col(layer), _col(source))
    return F.floor(micros / F.lit(60_000_000)).cast("bigint")


def lag_days(source: ColumnOrName, layer: ColumnOrName) -> Column:
    """Whole days from ``layer`` to ``source`` (dates)."""
    return F.datediff(_col(source), _col(layer)).cast("bigint")


def iso_timestamp(c: ColumnOrName) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` (six fraction digits when non-zero); '' for NULL."""
    c = _col(c)
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    fine = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = F.when(F.date_format(c, "SSSSSS") == F.lit("000000"), whole).otherwise(fine)
    return F.coalesce(text, F.lit(""))


def iso_date(c: ColumnOrName) -> Column:
    """``YYYY-MM-DD``; '' for NULL."""
    return F.coalesce(F.date_format(_col(c), "yyyy-MM-dd"), F.lit(""))


def decimal_text(c: ColumnOrName) -> Column:
    """Exact decimal text, e.g. ``604.75``."""
    return _col(c).cast("string")


def type_name(c: ColumnOrName) -> Column:
    """Upper-case a type name; ``DECIMAL(p,s)`` becomes ``DECIMAL``."""
    return F.regexp_replace(F.upper(F.trim(_col(c))), r"^DECIMAL\s*\(.*\)$", "DECIMAL")


def sla_status(
    lag_minutes_col: ColumnOrName,
    lag_days_col: ColumnOrName,
    sla_minutes_col: ColumnOrName,
    sla_days_col: ColumnOrName,
) -> Column:
    """``healthy`` / ``breach`` / ``unknown``; a minute lag with a minute SLA
    takes precedence over the day pair."""
    lm, ld = _col(lag_minutes_col), _col(lag_days_col)
    sm, sd = _col(sla_minutes_col), _col(sla_days_col)
    return (
        F.when(lm.isNotNull() & sm.isNotNull(),
               F.when(lm <= sm, F.lit("healthy")).otherwise(F.lit("breach")))
        .when(ld.isNotNull() & sd.isNotNull(),
              F.when(ld <= sd, F.lit("healthy")).otherwise(F.lit("breach")))
        .otherwise(F.lit("unknown"))
    )


def is_status(c: ColumnOrName, literal: str) -> Column:
    return _col(c) == F.lit(literal)
