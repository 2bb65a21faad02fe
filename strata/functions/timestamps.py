"""Injected run instants.

Jobs never read the clock inside a plan: the run time is a parameter and
enters as a literal, so a rerun with the same parameters gives the same rows.
Instants are ``TIMESTAMP_NTZ`` (wall-clock UTC by convention) so they read the
same whatever the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(when: datetime | date | str) -> Column:
    if isinstance(when, datetime):
        text = when.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(when, date):
        text = when.isoformat() + " 00:00:00"
    else:
        text = str(when)
    return F.lit(text).cast("timestamp_ntz")


def date_lit(when: date | str) -> Column:
    return F.lit(when if isinstance(when, str) else when.isoformat()).cast("date")
