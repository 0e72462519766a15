"""forumlens: Q&A community analytics on Spark DataFrames.

Sub-packages: ``sources`` (readers, writers, adapter views), ``functions``
(column expressions), ``operators`` (ranking, joins, aggregation,
comparison) and ``plans`` (the composite questions and activity series).
"""

__version__ = "0.1.0"
