"""encore: listening analytics on Spark.

Staging -> star schema -> weekly report, as DataFrame operators.
"""

__version__ = "0.1.0"
