"""Text cleaning."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no date" in the raw date columns.
NO_DATE = ("", "null")
# The Unicode whitespace characters.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def upper_trim(column: Column) -> Column:
    return F.upper(F.trim(column))


def tabs_to_spaces(column: Column) -> Column:
    return F.trim(F.replace(column, F.lit("\t"), F.lit(" ")))


def varchar(column: Column, length: int) -> Column:
    """A warehouse VARCHAR(n) cast cuts; Spark's cast does not."""
    return F.left(column.cast("string"), F.lit(length))


def text_date(column: Column, strict: bool = True, default: Column | None = None) -> Column:
    """Text to date; NULL and the sentinels give `default` (NULL when omitted).

    A bad date fails the job when `strict`, as the warehouse cast does; with
    `strict=False` it becomes NULL.
    """
    as_date = column.cast("date") if strict else column.try_cast("date")
    fallback = F.lit(None).cast("date") if default is None else default
    return F.when(column.isNotNull() & ~column.isin(*NO_DATE), as_date).otherwise(fallback)


def strip(column: Column) -> Column:
    """Remove whitespace of any kind from both ends (trim() removes spaces only)."""
    return F.btrim(column, F.lit(WHITESPACE))


def initials(name: Column) -> Column:
    """Upper-case initials of the first two words."""
    words = F.slice(F.split(strip(name), f"[{WHITESPACE}]+"), 1, 2)
    return F.upper(F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), ""))


def url_decode(column: Column) -> Column:
    """Percent and plus decoding; a percent sign without two hex digits stands for itself.

    Text that cannot be decoded even so is kept as it is.
    """
    escaped = F.regexp_replace(column, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), column)


def file_stem(path: Column) -> Column:
    """Last path element without '.pdf' / '.PDF'."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.replace(F.replace(name, F.lit(".pdf"), F.lit("")), F.lit(".PDF"), F.lit(""))
