"""flowscope: web-log and network-flow analytics as Spark DataFrame functions.

Every public function takes DataFrames (or a session and a table folder) and
returns a DataFrame built from Spark SQL expressions; nothing is collected to
the driver and no Python UDF runs in a hot path.
"""

__all__ = ["session", "sources", "functions", "operators", "streaming", "plans"]
