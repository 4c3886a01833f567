"""Masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: every character before the last @ except the leading one.
MAIL_LOCAL_PART = r"(?<=.).(?=[^@]*@)"


def mask_email(column: Column | str) -> Column:
    """``john@x.com`` -> ``j***@x.com``; text without an @ and nulls stay as they are."""
    return F.regexp_replace(column, MAIL_LOCAL_PART, "*")
