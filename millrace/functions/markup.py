"""Pulling elements out of page markup with regular expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def elements(xml: Column, name: str) -> Column:
    """Array of every ``<name ...>...</name>``, tags included. A body holds at least one character,
    and ``name`` is a prefix match, so ``id`` also finds ``<idx>...</id>``."""
    tag = re.escape(name)
    # Fixed value: the pattern of an element.
    return F.regexp_extract_all(xml, F.lit(rf"(?s)(<{tag}[^>]*?>.+?</{tag}>)"), 1)


def element_text(xml: Column, name: str) -> Column:
    """Body of the first ``<name ...>``, or the empty string."""
    tag = re.escape(name)
    # Fixed value: the pattern of an element's body.
    return F.regexp_extract(xml, rf"(?s)<{tag}[^>]*?>(.+?)</{tag}>", 1)


def element_id(xml: Column) -> Column:
    """First ``<id>`` as a bigint, -1 if there is none; anything else that is no number fails."""
    text = element_text(xml, "id")
    return F.when(text == "", F.lit(-1).cast("bigint")).otherwise(text.cast("bigint"))


def utc_instant(text: Column, strict: bool = True) -> Column:
    """ISO-8601 text ending in ``Z`` as a UTC wall-clock timestamp.

    The zone-free type keeps years independent of the session's time zone. Text that is no such
    instant fails the query if ``strict``, else becomes null.
    """
    parsed = text.try_cast("timestamp_ntz")
    ok = text.endswith("Z") & parsed.isNotNull()
    if strict:
        bad = F.raise_error(F.concat(F.lit("not an ISO-8601 instant: "), text)).cast("timestamp_ntz")
        return F.when(ok, parsed).otherwise(bad)
    return F.when(ok, parsed)


def revision(xml: Column, strict: bool = True) -> Column:
    """One ``<revision>`` as ``struct<rid, contributor, ts>``; the user name wins over the ip."""
    user = element_text(xml, "username")
    return F.struct(
        element_id(xml).alias("rid"),
        F.when(user == "", element_text(xml, "ip")).otherwise(user).alias("contributor"),
        utc_instant(element_text(xml, "timestamp"), strict).alias("ts"),
    )


def instant_text(ts: Column) -> Column:
    """ISO-8601 text of a zone-free UTC timestamp, with 0, 3 or 6 fraction digits as needed."""
    text = ts.cast("timestamp_ntz").cast("string")  # no zone is looked up on the way
    digits = F.substring(text, F.lit(21), F.lit(6))
    fraction = (
        F.when(digits == "", F.lit(""))
        .when(F.length(digits) <= 3, F.concat(F.lit("."), F.rpad(digits, 3, "0")))
        .otherwise(F.concat(F.lit("."), F.rpad(digits, 6, "0")))
    )
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), fraction, F.lit("Z"))
