"""Small tables for the operators' tests."""
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])


def docs(spark, rows):
    """rows: (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS).repartition(3)


def odd_columns(df):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F
    for c in ("digest", "salt", "fp", "label", "node", "batch", "kept", "item_id", "slot_", "ids", "score"):
        df = df.withColumn(c, F.lit("x"))
    return df
