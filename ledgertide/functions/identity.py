"""Content-derived row identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(columns: Sequence[Column | str]) -> Column:
    """First 16 hex digits of SHA-256 over the concatenated column texts.

    The column order belongs to the identity; NULL counts as the empty string.
    """
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.substring(F.sha2(F.concat(*texts), 256), 1, 16)


def content_id(ledger: Column | str, columns: Sequence[Column | str]) -> Column:
    """``<ledger>-<hash>``: equal content on the same ledger has equal identity."""
    ledger = F.col(ledger) if isinstance(ledger, str) else ledger
    return F.concat(ledger.cast("string"), F.lit("-"), content_hash(columns))
