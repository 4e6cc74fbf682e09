"""Column-level functions: each takes and returns a ``Column`` (or adds columns
to a DataFrame) using built-in Spark expressions only."""

from tamper.functions.text import ellipsize, initcap_words, percent_text
from tamper.functions.time import (lag_minutes, lookback, null_if_future, seconds_between,
                                   ts_literal)

__all__ = ["ellipsize", "initcap_words", "percent_text", "lag_minutes", "lookback",
           "null_if_future", "seconds_between", "ts_literal"]
