"""Web access log lines: ``timestamp LEVEL key=value key=value ...``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The keys read from each line.
LOG_KEYS = ("ip", "user_id", "page", "action")


def parse_access_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Six text fields per line.

    A line of one word has no level (NULL); a key that does not occur gives ''.
    """
    words = F.split(F.col(value), " ")
    fields = {"timestamp": F.get(words, F.lit(0)), "level": F.get(words, F.lit(1))}
    for key in LOG_KEYS:
        fields[key] = F.regexp_extract(F.col(value), f"{key}=([^ ]+)", 1)
    rest = [F.col(name) for name in lines.columns if name != value]
    return lines.select(*[col.alias(name) for name, col in fields.items()], *rest)
