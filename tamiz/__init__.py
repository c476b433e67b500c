"""tamiz: auditable feed cleaning on PySpark.

Dirty text feeds go in; typed, classified tables, a reject log, run counters
and keyed summaries come out.  Everything is DataFrame / Column expressions.
"""

__version__ = "0.1.0"
