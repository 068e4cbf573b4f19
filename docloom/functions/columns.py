"""Small column builders. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as blank at the ends of a text (Unicode white space plus the four
# ASCII separators). Fixed values.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def present(value: str | Column) -> Column:
    """Null for an empty string: an empty value counts as a missing one."""
    return F.nullif(col(value), F.lit(""))


def or_default(value: str | Column, default: str | Column) -> Column:
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(present(value), fallback)


def stripped(value: str | Column) -> Column:
    return F.btrim(col(value), F.lit(BLANKS))


def sha256(value: str | Column) -> Column:
    return F.sha2(col(value).cast("binary"), 256)


def derived_id(*parts: str | Column) -> Column:
    """UUID-shaped id that depends only on its parts, so a replayed batch makes the same ids.

    Bars and backslashes inside a part are escaped and a null part has a mark of its own, so different
    parts never join to the same text.
    """
    def marked(part: str | Column) -> Column:
        text = F.replace(col(part).cast("string"), F.lit("\\"), F.lit("\\\\"))
        return F.coalesce(F.replace(text, F.lit("|"), F.lit("\\|")), F.lit("\\0"))

    digest = F.sha2(F.concat_ws("|", *[marked(p) for p in parts]), 256)
    # One use of the digest: ids are built from ids, and a repeated operand would multiply.
    return F.regexp_replace(
        digest, "^(.{8})(.{4})(.{4})(.{4})(.{12}).*$", "$1-$2-$3-$4-$5")


def first_code(*cases: tuple[Column, str]) -> Column:
    """Code of the first case that holds, else null. The order of the cases is the precedence."""
    return F.coalesce(*[F.when(condition, F.lit(code)) for condition, code in cases])


def iso_instant(ts: str | Column) -> Column:
    """ISO-8601 text in UTC; whole seconds carry no fraction."""
    fraction = F.date_format(col(ts), "SSSSSS")
    seconds = F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(
        seconds,
        F.when(fraction == "000000", F.lit("")).otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00"),
    )


def backoff_seconds(attempts: str | Column) -> Column:
    """Two to the power of the attempt (at most 8), never above five minutes."""
    power = F.pow(F.lit(2), F.least(col(attempts), F.lit(8))).cast("int")
    return F.least(F.lit(300), power)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
