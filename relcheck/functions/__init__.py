"""Scalar column functions. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from relcheck.functions.text import (  # noqa: F401
    ASCII_WS, definition_hash, glob_to_regex, glob_match, normalize_text,
    trim_ws, session_key, lenient,
)
from relcheck.functions.time import epoch_millis_to_ts, iso8601_utc, ts_text  # noqa: F401
