"""kotonoha: quality control, release and corpus preparation of speech and text data on Spark.

Every operator takes DataFrames and returns a lazy DataFrame; file access lives in ``sources``.
"""
