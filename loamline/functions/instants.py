"""Free-form timestamps to instants, as Catalyst expressions without exceptions or Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rewriting steps, each leaving other notations as they are. A chain, so that the expression stays linear.
_STEPS = [
    (r"^(\d{1,2})\.(\d{1,2})\.(\d{4})", "$3-$2-$1"),  # day first with dots
    (r"^(\d{4})(\d{2})(\d{2})T", "$1-$2-$3T"),  # compact date
    (r"^(\d{4})/(\d{1,2})/", "$1-$2-"),  # slashes
    (r"T(\d{2})(\d{2})(\d{2})?(?=[Z+., -]|$)", "T$1:$2:$3"),  # compact time
    (r"\s*(?:UTC|GMT)$", "Z"),  # zone names
    (r"\s*WAT$", "+01:00"),
    (r"\s*CAT$", "+02:00"),
    (r"\s*EAT$", "+03:00"),
    (r"\s*([+-]\d{2})(\d{2})$", "$1:$2"),  # offsets without a colon, then without minutes
    (r"\s*([+-]\d{2})$", "$1:00"),
    (r"^(\S+[T ]+[\d:.]+)$", "$1Z"),  # no zone: UTC
    (r"([T ]\d{1,2}):?(?=[Z+-])", "$1:00:00"),  # to the hour, to the minute
    (r"([T ]\d{1,2}:\d{1,2}):?(?=[Z+-])", "$1:00"),
]
_FULL = r"^\d{4}-\d{1,2}-\d{1,2}[T ]+\d{1,2}:\d{1,2}:\d{1,2}([.]\d+)?(Z|[+-]\d{2}:\d{2})$"
_PLAIN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})?$"


def instant_micros(text: Column | str) -> Column:
    """Microseconds since 1970 (UTC) that a free-form timestamp names, to the hour or finer; null if it names none.

    Read: year-first dates with ``-`` or ``/``, day-first dates with dots, compact ``yyyymmddThhmmss``; an offset or zone
    mark if present, else UTC; all digits count from 1970 in seconds, milliseconds or microseconds by their magnitude.
    A date alone, a month alone, impossible dates and anything else give null. Nothing here throws.
    """
    s = F.upper(F.trim(F.col(text) if isinstance(text, str) else text))
    plain = F.when(F.length(s) == 19, F.concat(s, F.lit("Z"))).otherwise(s)
    other = F.translate(s, ",", ".")
    for pattern, to in _STEPS:
        other = F.regexp_replace(other, pattern, to)
    civil = F.when(s.rlike(_PLAIN), plain).otherwise(F.regexp_extract(other, _FULL, 0))
    digits = s.try_cast("bigint")
    epoch = F.when(F.length(s) <= 11, digits * 1_000_000).when(F.length(s) <= 14, digits * 1_000).otherwise(digits)
    return F.when(s.rlike(r"^\d{1,16}$"), epoch).otherwise(F.unix_micros(civil.try_cast("timestamp")))
