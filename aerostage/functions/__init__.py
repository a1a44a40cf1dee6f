"""Column expressions: every function takes and returns ``pyspark.sql.Column`` (JVM-side, codegen)."""

from aerostage.functions.casts import (  # noqa: F401
    epoch_to_timestamp,
    parse_local_time,
    parse_utc_time,
    safe_cast,
    try_date,
    try_double_text,
    try_long,
)
from aerostage.functions.flags import completeness_flag, reliability_score  # noqa: F401
from aerostage.functions.text import airline_iata_fallback, airline_icao_fallback, trim, upper, upper_trim  # noqa: F401
from aerostage.functions.time import day_bounds  # noqa: F401
