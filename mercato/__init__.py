"""mercato — marketplace order analytics as Spark DataFrame queries.

Layers:
  sources    typed readers / writers and the fixture adapter
  functions  column expressions (business rules, exact money, exact median)
  operators  DataFrame -> DataFrame transforms (clean, enrich, marts, feeds,
             profiling, data-quality checks, report)
  plans      session defaults, scratch folders, join helpers, the
             registered queries with their SQL twins, the batch runner
"""

__version__ = "0.1.0"
