"""orderlens: e-commerce order analytics as Spark DataFrame plans.

Layers:
  sources    table scans, the test-data adapter, sinks
  functions  column expressions (cleaning, derivations, money arithmetic)
  operators  joins, marts, order-level frame, trends, insights, filters, contracts
  plans      facts plan, the query catalog, the full refresh job, DuckDB oracle SQL
  streaming  JSON codec, stream ingest with a checkpointed append sink
"""

__version__ = "0.1.0"
