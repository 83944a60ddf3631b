"""Robot-training-data preparation as Spark DataFrame operators.

Every operator is a plain function from DataFrame to DataFrame. One job covers
all datasets: a dataset directory is a key column, never a Python loop.
"""
