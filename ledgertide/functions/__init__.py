"""Column-level building blocks (all JVM-side expressions)."""

from .identity import content_id
from .jsonvalues import find_by_key, i128_text, json_scalar, keys_of, with_integers
from .numbers import scaled_amount, scaled_rate, q4w_percent
from .timewindow import date_window, iso_z, parse_day, parse_instant, preset_window
from .wellformed import is_address, is_iso_day

__all__ = [
    "content_id", "find_by_key", "i128_text", "json_scalar", "keys_of", "with_integers", "scaled_amount", "scaled_rate", "q4w_percent",
    "date_window", "iso_z", "parse_day", "parse_instant", "preset_window", "is_address", "is_iso_day",
]
