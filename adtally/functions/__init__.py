"""Column expressions (all JVM-side built-ins, no Python UDFs)."""

from adtally.functions.dates import report_date_col, validate_date
from adtally.functions.ip import ip_to_long, long_to_ip, region_parts
from adtally.functions.rates import rate

__all__ = [
    "ip_to_long",
    "long_to_ip",
    "region_parts",
    "rate",
    "report_date_col",
    "validate_date",
]
