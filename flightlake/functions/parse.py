"""ANSI-safe text parsing as column expressions.

Every function returns a ``Column`` built from built-in functions only, so it
stays inside whole-stage codegen. "Bad text becomes null" is the intent of the
source jobs; under ANSI mode a plain ``cast`` raises instead, hence ``try_*``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DELAY_THRESHOLD_MIN, ICAO_PREFIX


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes(c) -> Column:
    """Delay text → double minutes; '', 'n/a', 'abc' → null (T2)."""
    return _c(c).try_cast("double")


def is_delayed(delay) -> Column:
    """Departure delay strictly above the threshold; null delay stays null."""
    return _c(delay) > F.lit(DELAY_THRESHOLD_MIN)


def flag(c) -> Column:
    """Indicator text → boolean (T3).

    Numeric text ('0', '1', '0.00', '1.00') is true when non-zero; other text
    goes through the boolean cast ('true', 'f', 'yes', ...); the rest is null.
    """
    num = _c(c).try_cast("double")
    return F.when(num.isNotNull(), num != F.lit(0.0)).otherwise(_c(c).try_cast("boolean"))


def hhmm_hour(c) -> Column:
    """Hour from hhmm text (T6): '5'→0, '830'→8, '0830'→8, '2400'→24, ''→0.

    The text is left-padded to four characters (which also truncates longer
    text) and the first two are read as an integer.
    """
    return F.substring(F.lpad(_c(c), 4, "0"), 1, 2).try_cast("int")


def month_of(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Month number of a text date; text not matching ``fmt`` → null (T7)."""
    return F.month(F.try_to_date(_c(c), fmt))


def year_of(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.year(F.try_to_date(_c(c), fmt))


def visibility(c) -> Column:
    """Visibility text → statute miles (T12): '10+' → 10.0, '' → null."""
    return F.regexp_replace(_c(c), r"\++$", "").try_cast("double")


def station_code(iata, prefix: str = ICAO_PREFIX) -> Column:
    """IATA airport code → ICAO station code by prefix (null stays null)."""
    return F.concat(F.lit(prefix), _c(iata))


def obs_timestamp(c) -> Column:
    """Observation time as a timestamp: epoch seconds or ISO-like text."""
    as_epoch = F.when(_c(c).rlike(r"^[0-9]{9,11}$"),
                      F.timestamp_seconds(_c(c).try_cast("bigint")))
    return F.coalesce(as_epoch, F.try_to_timestamp(_c(c)))
