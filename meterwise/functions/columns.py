"""Column -> Column helpers. All built-in expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterwise import schemas as S

# a word is a run of letters/digits; everything else separates words
_WORD_OR_GAP = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on any time zone."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(value).cast("timestamp_ntz")


def parse_ts(c: str | Column) -> Column:
    """Text -> TIMESTAMP_NTZ; unparseable text gives NULL instead of failing the job."""
    return _c(c).try_cast("timestamp_ntz")


def pg_initcap(c: str | Column) -> Column:
    """Upper-case the first letter of every word, lower-case the rest, where a word
    starts after any non-alphanumeric character (so ``o'neil mary-jane`` becomes
    ``O'Neil Mary-Jane``; Spark's own ``initcap`` only splits on spaces)."""
    parts = F.regexp_extract_all(_c(c), F.lit(_WORD_OR_GAP), F.lit(0))
    cap = F.transform(parts, lambda w: F.concat(F.upper(w.substr(F.lit(1), F.lit(1))),
                                                F.lower(w.substr(F.lit(2), F.length(w)))))
    return F.array_join(cap, "")


def row_json(*cols: str) -> Column:
    """The whole row as JSON text with NULL fields kept (``{"a":null}``)."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def record_hash(source: str, check_type: str, record: Column) -> Column:
    """Run-independent identity of a quarantined row."""
    return F.md5(F.concat(F.lit(source), F.lit(check_type), record))


def row_hash(*cols: str | Column, sep: str | None = None) -> Column:
    """MD5 over the text of the columns with NULL as ''. ``sep=None`` concatenates
    without a separator (the attribute hash as originally defined)."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat(*parts) if sep is None else F.concat_ws(sep, *parts))


def duration_sec(start: str | Column, end: str | Column) -> Column:
    """Exact seconds from start to end when end is later, else 0 (open or skewed sessions)."""
    s, e = _c(start), _c(end)
    micros = F.timestamp_diff("MICROSECOND", s, e).cast("decimal(24,0)")
    return (F.when(e > s, (micros / F.lit(1_000_000)).cast(S.DURATION_T))
            .otherwise(F.lit(0).cast(S.DURATION_T)))


def month_start(ts: str | Column) -> Column:
    return F.trunc(F.to_date(_c(ts)), "month")


def session_bucket(duration: str | Column) -> Column:
    d = _c(duration)
    return (F.when(d < S.SHORT_SESSION_SEC, F.lit(S.BUCKET_SHORT))
            .when(d < S.MEDIUM_SESSION_SEC, F.lit(S.BUCKET_MEDIUM))
            .otherwise(F.lit(S.BUCKET_LONG)))
