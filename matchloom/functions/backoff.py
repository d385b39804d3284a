"""Retry delays, revisit intervals and the state after a failure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubled(base: float, exponent: Column, cap: int) -> Column:
    return F.lit(float(base)) * F.pow(F.lit(2.0), F.least(exponent, F.lit(cap)))


def retry_delay(attempts: Column, base: float, max_delay: float) -> Column:
    return F.least(F.lit(float(max_delay) * 5), _doubled(base, attempts - 1, 3))


def revisit_interval(streak: Column, base: float, longest: float) -> Column:
    return F.least(F.lit(float(longest)), _doubled(base, streak, 8))


def source_failure_delay(failures: Column, base: float, longest: float) -> Column:
    return F.least(F.lit(float(longest)), _doubled(base, failures - 1, 8))


def pool_delay(failures: Column, is_source: Column) -> Column:
    """Next check of a pool source or candidate; zero failures means the last one worked."""
    failed = F.least(F.lit(3600.0), _doubled(120, failures, 5))
    worked = F.when(is_source, F.lit(86400.0)).otherwise(F.lit(7 * 86400.0))
    return F.when(failures > 0, failed).otherwise(worked)


def after_failure(attempts: Column, max_retries: int) -> Column:
    """Status once one more attempt has failed."""
    return F.when(attempts + 1 >= max_retries, F.lit("dead")).otherwise(F.lit("pending"))
