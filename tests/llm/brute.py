"""Small frames and plain versions to compare with."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=""):
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(row + (None, None))[:4] + (None if row[1] is None else len(row[1]),) for row in rows]
    frame = spark.createDataFrame(full, DOCS)
    return frame


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()
