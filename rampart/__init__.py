"""rampart: rule checks, tolerant table matching and run analytics as Spark jobs.

Every public operator takes DataFrames and returns DataFrames; nothing is
collected to the driver.  See README.md for the module map.
"""

__all__ = ["session", "operators", "sources", "functions", "plans", "streaming"]
