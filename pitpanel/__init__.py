"""pitpanel: point-in-time panels on Spark DataFrames.

Sub-packages: ``sources`` (readers, sinks, payload parsing), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame), ``plans`` (compositions and suites).
"""

from pitpanel.panel import Panel

__all__ = ["Panel"]
