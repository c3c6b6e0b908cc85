"""How long to wait before another try, as columns over logs of failed requests."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Status codes after which a request is worth another try.
RETRYABLE = (429, 500, 502, 503, 504)


def backoff(attempt: Column, base: float, most: float | None = None, first: int = 0) -> Column:
    """Seconds before the try after ``attempt`` (counted from ``first``): doubled each time, up to ``most``."""
    wait = F.lit(float(base)) * F.pow(F.lit(2.0), F.greatest(attempt - first, F.lit(0)))
    return wait if most is None else F.least(wait, F.lit(float(most)))


def http_date(c: Column) -> Column:
    """The time of an HTTP date; null for other text."""
    plain = F.regexp_extract(c, r"\A(?:[A-Za-z]{3}, )?(\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) GMT\z", 1)
    return F.try_to_timestamp(F.concat(F.nullif(plain, F.lit("")), F.lit(" +0000")), F.lit("dd MMM yyyy HH:mm:ss Z"))


def retry_delay(header: Column, now: Column, attempt: Column, base: int, most: int) -> Column:
    """Whole seconds to wait: as many as the header says, until the time it names, else the backoff; from 1 to ``most``."""
    said = F.btrim(header).try_cast("int")
    until = (http_date(header).cast("double") - now.cast("double")).cast("int")
    named = F.coalesce(said, until)
    return F.least(F.when(named.isNotNull(), F.greatest(named, F.lit(1))).otherwise(backoff(attempt, base, most, 1).cast("int")), F.lit(most))


def worth_retrying(status: Column, attempt: Column, most: int) -> Column:
    return F.coalesce(status.isin(*RETRYABLE) & (attempt <= most), F.lit(False))


def unpropagated(expected: DataFrame, seen: DataFrame, key: str, value: str) -> DataFrame:
    """Keys whose expected value isn't what is seen yet."""
    now = seen.select(key, F.col(value).alias("__seen"))
    return expected.join(now, key, "left").where(~F.col(value).eqNullSafe(F.col("__seen"))).select(key)


def wait_until_empty(pending: Callable[[], list], timeout: float, pause: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
    """Ask again until nothing is pending; a TimeoutError names what still is after ``timeout`` seconds."""
    end = clock() + timeout
    while left := pending():
        if clock() >= end:
            raise TimeoutError(f"still pending: {', '.join(map(str, left))}")
        sleep(pause)
