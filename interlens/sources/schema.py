"""Interaction schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_INT = T.IntegerType()

# raw interactions, all int, all nullable
INTERACTIONS = T.StructType([
    T.StructField("user_id", _INT),
    T.StructField("book_id", _INT),
    T.StructField("is_read", _INT),
    T.StructField("rating", _INT),
    T.StructField("is_reviewed", _INT),
])

# one JSON line of the genre dumps
GENRE_JSON = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("book_id", T.StringType()),
    T.StructField("is_read", T.BooleanType()),
    T.StructField("rating", _INT),
    T.StructField("review_text_incomplete", T.StringType()),
])
