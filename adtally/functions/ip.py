"""IPv4 text <-> number, and the `|`-separated dictionary region string.

The IPv4 conversions are rendered as Spark SQL expressions: one call into
the JVM per use instead of one per sub-expression, and Catalyst sees the same
built-in functions either way (codegen'd, no UDF).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A dotted quad is four decimal groups of 1-3 digits, each <= 255;
# a dictionary region string has five `|`-separated parts, of which the third
# is the province and the fourth the city (e.g. "country|0|province|city|isp").
DOTTED_QUAD = "^[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}$"
OCTET_MAX = 255
REGION_SEPARATOR = r"\|"
REGION_PARTS = 5
PROVINCE_PART = 2
CITY_PART = 3


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def ip_to_long_sql(ip: str) -> str:
    """SQL text of :func:`ip_to_long` for column ``ip``."""
    c = _ident(ip)
    # The split pattern is the two-character regex `\.`, written as
    # concat(chr(92), '.') so it needs no escaping in any parser mode; Catalyst
    # folds it to a literal, and Java splits on it without compiling a regex.
    # The address is split once: the fold adds each octet to 256 times the
    # number so far, and an octet above 255 makes the number NULL.
    octets = f"split({c}, concat(chr(92), '.'))"
    fold = f"aggregate({octets}, 0L, (n, o) -> IF(CAST(o AS BIGINT) <= {OCTET_MAX}, n * 256 + CAST(o AS BIGINT), NULL))"
    return f"CASE WHEN {c} RLIKE '{DOTTED_QUAD}' THEN {fold} END"


def ip_to_long(ip: str) -> Column:
    """Dotted-quad IPv4 string column -> bigint in [0, 2^32); NULL when malformed.

    NULL, empty, non-numeric, wrong number of groups, or a group above 255 all
    give NULL instead of an error, so one bad record never fails a job.
    """
    return F.expr(ip_to_long_sql(ip))


def long_to_ip_sql(n: str) -> str:
    c = _ident(n)
    octets = ", ".join(f"CAST(shiftright({c}, {s}) & 255 AS STRING)" for s in (24, 16, 8, 0))
    return f"CASE WHEN {c} IS NOT NULL THEN concat_ws('.', {octets}) END"


def long_to_ip(n: str) -> Column:
    """bigint column in [0, 2^32) -> dotted-quad string; NULL stays NULL."""
    return F.expr(long_to_ip_sql(n))


def region_parts(region) -> tuple[Column, Column]:
    """(province, city) from a dictionary region string.

    Uses ``get`` so a short string yields NULL instead of an ANSI index error;
    a string without exactly five parts yields NULL for both.
    """
    parts = F.split(F.col(region) if isinstance(region, str) else region, REGION_SEPARATOR)
    ok = F.size(parts) == REGION_PARTS
    return (
        F.when(ok, F.get(parts, PROVINCE_PART)),
        F.when(ok, F.get(parts, CITY_PART)),
    )
