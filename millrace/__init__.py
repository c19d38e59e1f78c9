"""Batch analytics jobs on Spark: delimited text, graph traversal, clustering,
feature encoding, regression and classification.

Every operator takes DataFrames and returns DataFrames; sessions, paths,
columns and hyperparameters are arguments.
"""
