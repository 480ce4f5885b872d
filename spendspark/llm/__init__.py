"""Operators of a training-data pipeline over documents, labels and embeddings.

Nothing outside this folder imports it. Every operator takes and returns DataFrames, reads only
the columns it names, and keeps what it stores in between below ``spark.checkpoint.dir``.
"""
