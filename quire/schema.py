"""Schemas of feed records.

``categories`` is read as text because it may be a JSON array or a single
string; ``functions.papers.coerce_categories`` turns it into a list.
"""
from pyspark.sql import types as T

AI_TYPE = T.StructType([T.StructField(f, T.StringType()) for f in
                        ["tldr", "motivation", "method", "result", "conclusion"]])

VERDICT_TYPE = T.StructType([
    T.StructField("relevant", T.BooleanType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("reason", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
])

# Raw paper as a crawler writes it (one JSON object per line).
PAPER_JSON = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("pdf", T.StringType()),
    T.StructField("abs", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("title", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("AI", AI_TYPE),
    T.StructField("code_url", T.StringType()),
    T.StructField("code_stars", T.LongType()),
    T.StructField("code_last_update", T.StringType()),
    T.StructField("topic_filter", VERDICT_TYPE),
])

CORRUPT_COL = "_corrupt_record"
