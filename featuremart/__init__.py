"""Spark-native feature store, label store, model training and model monitoring for loan data.

``functions``  Column -> Column expressions
``sources``    raw and partitioned tables, scratch space, the month spine
``operators``  DataFrame -> DataFrame building blocks
``plans``      composed flows: silver, gold, training, scoring, monitoring, run summary
"""
