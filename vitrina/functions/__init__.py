"""Column-expression helpers (built-in Spark functions only)."""

from vitrina.functions.coerce import (clip_rating, nan_to_null, to_date, to_decimal, to_double,
                                      to_int, to_timestamp)
from vitrina.functions.keys import date_key, seconds_to_hms, time_key_from_text, time_key_from_ts
from vitrina.functions.text import email_norm, full_name, preview, title_case, truncate, ustrip

__all__ = ["clip_rating", "nan_to_null", "to_date", "to_decimal", "to_double", "to_int", "to_timestamp",
           "date_key", "seconds_to_hms", "time_key_from_text", "time_key_from_ts",
           "email_norm", "full_name", "preview", "title_case", "truncate", "ustrip"]
