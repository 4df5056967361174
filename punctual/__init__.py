"""Punctuality analytics as plain Spark DataFrame functions.

``functions``  column expressions (calendar, clock, text, hashing)
``operators``  DataFrame -> DataFrame operators
``sources``    schemas, readers and writers
``plans``      whole preparation, clustering and regression paths
``catalog``    every operator as a runnable query with its SQL twin
"""
