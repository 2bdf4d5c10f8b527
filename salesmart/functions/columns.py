"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY, TOTAL, TS


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_null(cols: list[str]) -> Column:
    """``a IS NULL OR b IS NULL OR ...`` (never UNKNOWN)."""
    return reduce(or_, [F.col(c).isNull() for c in cols])


def valid_money(c: str | Column) -> Column:
    """The whole text is a plain decimal, not negative before rounding, that the
    typed column can hold.  Never UNKNOWN: NULL is not valid."""
    text = F.trim(col(c).cast("string"))
    plain = text.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$")
    return F.coalesce(plain & (text.try_cast("decimal(38,10)") >= 0) & to_money(c).isNotNull(), F.lit(False))


def to_timestamp_ntz(c: str | Column) -> Column:
    """Typed timestamp of a landing value, NULL unless the whole text is one;
    a bare date becomes midnight."""
    return col(c).try_cast(TS)


def valid_timestamp(c: str | Column) -> Column:
    return to_timestamp_ntz(c).isNotNull()


def to_money(c: str | Column) -> Column:
    return F.trim(col(c).cast("string")).try_cast(MONEY)


def month_year(ts: str | Column) -> Column:
    """``FORMAT(ts, 'yyyy-MM')``."""
    return F.date_format(col(ts), "yyyy-MM")


def quarter_label(month: str | Column) -> Column:
    """Year, ``-Q`` and the month's quarter, from a ``yyyy-MM`` label.

    ``concat_ws`` rather than ``concat``: NULL counts as an empty string, so
    a NULL month gives ``-Q`` instead of NULL.
    """
    m = col(month)
    q = F.ceil(F.right(m, F.lit(2)).cast("int") / F.lit(3.0)).cast("int")
    return F.concat_ws("", F.left(m, F.lit(4)), F.lit("-Q"), q.cast("string"))


def year_label(month: str | Column) -> Column:
    """``LEFT(month_year, 4)``."""
    return F.left(col(month), F.lit(4))


def as_total(c: str | Column) -> Column:
    return col(c).cast(TOTAL)


def _present(c: Column) -> Column:
    # A header that is missing or empty counts as absent (Python truthiness).
    return c.isNotNull() & (F.length(c) > 0)


def client_key(forwarded_for: str | Column, real_ip: str | Column,
               remote_addr: str | Column) -> Column:
    """Client address from request headers, port removed.

    First entry of the forwarded-for list if that header is non-empty, else
    the real-ip header if non-empty, else the socket address; then the part
    before the first ``:`` (this also cuts IPv6 addresses, as the original).
    """
    xff, rip, addr = col(forwarded_for), col(real_ip), col(remote_addr)
    raw = (F.when(_present(xff), F.split_part(xff, F.lit(","), F.lit(1)))
           .when(_present(rip), rip)
           .otherwise(addr))
    return F.split_part(raw, F.lit(":"), F.lit(1))


def local_time_text(ts: str | Column, tz: str = "UTC") -> Column:
    """UTC time rendered in zone ``tz`` as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(F.from_utc_timestamp(col(ts).cast("timestamp"), tz),
                         "yyyy-MM-dd HH:mm:ss")
