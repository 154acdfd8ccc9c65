"""marketlake: financial and macro data operators as Spark DataFrame jobs.

Sub-packages:
  sources    landed-file scans, typed tables, staged sinks
  functions  Column-expression scalars (ids, period codes, text rules)
  operators  DataFrame -> DataFrame operators (filters, joins, aggs, upserts,
             reshape, hierarchies, features, regime model)
  streaming  Structured Streaming twins of the incremental loaders
  plans      the registered queries over the driver tables and their SQL twins
"""

__version__ = "0.1.0"
