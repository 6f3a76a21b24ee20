"""Apply a column function to a handful of values."""


def apply(spark, fn, rows, schema="v string"):
    """[fn(row's columns)] in input order."""
    from pyspark.sql import functions as F

    data = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, f"_i int, {schema}")
    cols = [F.col(c) for c in df.columns[1:]]
    return [r.out for r in df.select("_i", fn(*cols).alias("out")).orderBy("_i").collect()]
