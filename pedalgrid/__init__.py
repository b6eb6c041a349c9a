"""Bike-share demand analytics expressed as plain PySpark DataFrame jobs.

Layout
------
``schemas``    table layouts and fixed label lists
``session``    session defaults, shared scratch folder, staged tables
``functions``  column expressions (time parsing, measures)
``sources``    readers and writers
``operators``  DataFrame -> DataFrame building blocks
``plans``      the composed jobs, from raw rides to the enriched daily table
"""

__version__ = "0.1.0"
