"""Reading judges' replies and numeric labels."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.functions.text import bare_json, inner_quotes_repaired, plain_punctuation


def reply_json(reply: Column, *, repair: bool = False) -> Column:
    """A reply as the JSON text that it means to be."""
    c = bare_json(plain_punctuation(reply))
    return inner_quotes_repaired(c) if repair else c


def json_value(reply: Column, key: str, *, repair: bool = False, strict: bool = False) -> Column:
    """The value of a key in a reply, as a string; null if the reply isn't a JSON object or lacks it.

    ``strict`` reads with a Python parser, by Arrow batches; otherwise Spark's own reader
    does, behind a guard against text around the object.
    """
    text = reply_json(reply, repair=repair)
    if strict:
        return _strict(key)(text)
    schema = T.StructType([T.StructField(key, T.StringType())])
    value = F.from_json(text, schema, {"allowSingleQuotes": "false"})[key]
    return F.when(text.rlike(r"^\{.*\}$"), value)


def json_list(reply: Column, key: str) -> Column:
    """The value of a key as a list of strings; null if it is none."""
    text = reply_json(reply)
    schema = T.StructType([T.StructField(key, T.ArrayType(T.StringType()))])
    return F.when(text.rlike(r"^\{.*\}$"), F.from_json(text, schema, {"allowSingleQuotes": "false"})[key])


def _strict(key: str):
    def one(text: str | None) -> str | None:
        if text is None:
            return None
        try:
            value = json.loads(text)[key]
        except (ValueError, KeyError, TypeError, RecursionError):
            return None
        return value if isinstance(value, str) else None if value is None else json.dumps(value, ensure_ascii=False)

    @F.pandas_udf("string")
    def read(s: pd.Series) -> pd.Series:
        return s.map(one)

    return read


def as_number(label: Column) -> Column:
    """A label as a double, as Python's float() would take it; null if it would not.

    Spark alone reads "3f" and "3d"; underscores and full-width digits are Python's.
    """
    text = F.translate(label.cast("string"), "０１２３４５６７８９", "0123456789")
    text = F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    ends_in_letter = text.rlike(r"(?i)(?<!in)[fd]\s*$")
    return F.when(~ends_in_letter, text.try_cast("double"))


def normalised(label: Column, top: float = 5.0) -> Column:
    """A label on a scale to ``top`` as one from 0 to 1."""
    return label / F.lit(top)
