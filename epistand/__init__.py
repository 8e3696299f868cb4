"""epistand: population-health rates on Spark.

Operators (``epistand.operators``) and column builders (``epistand.functions``) are
DataFrame -> DataFrame / Column functions; ``epistand.plans`` composes them into the published
topic outputs; ``epistand.sources`` holds schemas, readers, sinks and the test-table adapters.
"""

__version__ = "0.1.0"
