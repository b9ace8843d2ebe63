"""daybook: user-behaviour analytics as Spark DataFrame jobs.

Sub-packages: ``functions`` (Column expressions), ``sources`` (readers / writers and
session helpers), ``operators`` (DataFrame -> DataFrame building blocks), ``plans``
(composite jobs and the driver queries), ``streaming`` (Structured Streaming entry
points for the stateless cleanse).
"""
__version__ = "0.1.0"
