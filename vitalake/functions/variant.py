"""Column helpers over VARIANT bronze columns and landed ISO text.

All extraction goes through ``try_variant_get`` on the binary variant (no
``to_json`` + ``get_json_object`` text round trip) and every cast is a
``try_`` form, so a bad document yields NULL instead of failing the job
under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 with optional fraction (1-6 digits) and a zone that may be ``Z``
# or a numeric offset.
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def vget(col: Column | str, path: str, dtype: str) -> Column:
    return F.try_variant_get(_c(col), path, dtype)


def body_str(path: str) -> Column:
    return vget("body", path, "string")


def body_dbl(path: str) -> Column:
    return vget("body", path, "double")


def body_long(path: str) -> Column:
    return vget("body", path, "bigint")


def header(name: str) -> Column:
    """Header value by exact key; hyphenated keys need the bracket path."""
    return vget("headers", f"$['{name}']", "string")


def parse_ts(col: Column | str) -> Column:
    """ISO instant text -> TIMESTAMP (``Z``, millis, micros, offsets).  The cast reads these forms
    without a formatter; the pattern is tried only on what the cast leaves NULL."""
    c = _c(col)
    return F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit(ISO_INSTANT)))


def str_map(col: Column | str, path: str = "$") -> Column:
    """Any-typed JSON object -> MAP<STRING,STRING>; empty -> NULL."""
    m = F.transform_values(vget(col, path, "map<string,variant>"),
                           lambda _k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
    return F.when(F.size(m) > 0, m)


def drop_key(col: Column | str, key: str) -> Column:
    """Variant object minus one top-level key (nested values are kept)."""
    m = vget(col, "$", "map<string,variant>")
    return F.to_variant_object(F.map_filter(m, lambda k, _v: k != F.lit(key)))


def iso_z(ts: Column) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ssZ`` (the HealthKit wire form)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_millis_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_offset(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
