"""Composed retail pipelines.

Frames use lower-case retail column names (``customernumber``, ``paymentdate``,
``productcode`` ...). Except in ``daily``, which strings the pipelines together with
sources and sinks, nothing here writes results. Numbering, merging and keyword matching
stage intermediate data when they are called. The load date is an argument; left out, it
is Spark's current date.
"""
