"""Scrubbing of log records: fields are withheld by name, credentials in values by shape, conversation text unless allowed."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WITHHELD = "[redacted]"
CONTENT_WITHHELD = "[redacted:content]"
CUT = "…[truncated]"
CONTENT_CHARS = 4000
DEPTH = 6
# Name segments and neighbouring pairs that withhold a field, and shapes that withhold a span.
SEGMENTS = ("token", "secret", "password", "passwd", "credential", "credentials", "authorization", "cookie", "cookies", "jwt", "bearer", "apikey")
PAIRS = ("api key", "access key", "private key", "secret key", "auth header", "auth token")
SHAPES = (
    r"(?i)\b(?:Bearer|Basic|Token)\s+[A-Za-z0-9._\-+/=]{8,}",
    r"\beyJ[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]{4,}",
    r"\b(?:sk|pk|rk)-(?:[A-Za-z0-9]+-)?[A-Za-z0-9_-]{16,}",
    r"\bgh[pousr]_[A-Za-z0-9]{16,}",
    r"(?<=://)[^\s/:@]+:[^\s/@]+(?=@)",
)
_NAME = rf"(?:^| )(?:{'|'.join((*SEGMENTS, *PAIRS))})(?: |$)"


def withheld_name(name: Column) -> Column:
    """Whether a field's name says that its value is a credential: whole segments, or neighbouring pairs."""
    return F.trim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", " ")).rlike(_NAME)


def scrub_shapes(value: Column) -> Column:
    """Each credential-shaped span replaced; the text around it stays."""
    for shape in SHAPES:
        value = F.regexp_replace(value, shape, WITHHELD)
    return value


def scrub_fields(fields: Column) -> Column:
    """A map<string,string> of log fields, scrubbed: names by shape, values by name and shape."""
    return F.map_from_entries(F.transform(F.map_entries(fields), lambda e: F.struct(scrub_shapes(e["key"]).alias("key"), F.when(withheld_name(e["key"]), F.lit(WITHHELD)).otherwise(scrub_shapes(e["value"])).alias("value"))))


def content_text(text: Column, allowed: Column) -> Column:
    """Conversation text: withheld, or cut to CONTENT_CHARS and scrubbed by shape."""
    cut = F.when(F.length(text) > CONTENT_CHARS, F.concat(F.left(text, F.lit(CONTENT_CHARS)), F.lit(CUT))).otherwise(text)
    return F.when(text.isNotNull(), F.when(allowed, scrub_shapes(cut)).otherwise(F.lit(CONTENT_WITHHELD)))


def scrub_json(value: str) -> str:
    """A JSON record with all levels scrubbed; what is deeper than DEPTH, or no JSON at all, is withheld."""
    shapes = [re.compile(s) for s in SHAPES]
    names = re.compile(_NAME)

    def shaped(text: str) -> str:
        for s in shapes:
            text = s.sub(WITHHELD, text)
        return text

    def walk(name: str | None, x: object, depth: int) -> object:
        if depth > DEPTH or name is not None and names.search(re.sub("[^a-z0-9]+", " ", name.lower()).strip()):
            return WITHHELD
        if isinstance(x, str):
            return shaped(x)
        if isinstance(x, dict):
            return {shaped(k): walk(k, v, depth + 1) for k, v in x.items()}
        if isinstance(x, list):
            return [walk(None, v, depth + 1) for v in x]
        return x

    try:
        record = json.loads(value)
        if not isinstance(record, dict):
            return json.dumps(walk(None, record, 0), ensure_ascii=False)
        return json.dumps({shaped(k): walk(k, v, 0) for k, v in record.items()}, ensure_ascii=False)
    except (ValueError, RecursionError):
        return WITHHELD


@F.pandas_udf(T.StringType())
def scrubbed_json(values: pd.Series) -> pd.Series:
    """scrub_json of a column of nested records."""
    return values.map(scrub_json, na_action="ignore")
