"""Retail lake operators and pipelines, written against the Spark DataFrame API.

Sub-packages:

- ``sources`` / ``sinks``  reading and writing databases, files and catalog tables
- ``functions``            column expressions (dates, product indicators, score levels)
- ``operators``            DataFrame -> DataFrame building blocks
- ``plans``                the composed retail pipelines
- ``catalogue``            every operator as a query over the provided test tables
"""
