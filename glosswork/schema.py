"""Stored tables: names and column contracts."""

from pyspark.sql import types as T

SUMMARIES = T.StructType(
    [
        T.StructField("abstract_id", T.StringType(), False),
        T.StructField("abstract", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("rouge_score", T.FloatType()),
    ]
)
# Topics and rejected ids are tables of their own, joined at read: a topic run
# then never rewrites the summaries.
TOPICS = T.StructType(
    [
        T.StructField("abstract_id", T.StringType(), False),
        T.StructField("topic_id", T.IntegerType()),
        T.StructField("topic_label", T.StringType()),
        T.StructField("topic_score", T.FloatType()),
        T.StructField("model_version", T.IntegerType()),
    ]
)
VECTORS = T.StructType(
    [
        T.StructField("abstract_id", T.StringType(), False),
        T.StructField("embedding", T.ArrayType(T.FloatType()), False),
    ]
)
# The gate that blocked an id is kept: a lower gate lets the id in again.
REJECTED = T.StructType(
    [
        T.StructField("abstract_id", T.StringType(), False),
        T.StructField("rouge_score", T.FloatType()),
        T.StructField("threshold", T.DoubleType()),
    ]
)
IDF = T.StructType(
    [
        T.StructField("term", T.StringType(), False),
        T.StructField("idf", T.DoubleType()),
        T.StructField("n_docs", T.LongType()),
    ]
)
# What a model does with a centroid: its topic after merging, -1 for noise.
TOPIC_RULES = T.StructType(
    [
        T.StructField("centroid", T.IntegerType(), False),
        T.StructField("topic_id", T.IntegerType()),
        T.StructField("min_score", T.DoubleType()),
        T.StructField("model_version", T.IntegerType()),
    ]
)
TOPIC_LABELS = T.StructType(
    [
        T.StructField("topic_id", T.IntegerType()),
        T.StructField("topic_label", T.StringType()),
        T.StructField("model_version", T.IntegerType()),
    ]
)
TABLES = {
    "summaries": SUMMARIES,
    "topics": TOPICS,
    "vectors": VECTORS,
    "rejected": REJECTED,
    "idf": IDF,
    "topic_rules": TOPIC_RULES,
    "topic_labels": TOPIC_LABELS,
}
# Tables stored by these columns; reads of one version skip the others.
STORED_BY = {"topics": ["model_version"], "topic_rules": ["model_version"], "topic_labels": ["model_version"]}
