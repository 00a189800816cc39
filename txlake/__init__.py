"""txlake: Spark-native analytics over a lake of blockchain transactions.

Layout:
  schema      table / envelope schemas and fixed domain constants
  session     session defaults and the shared scratch area
  functions   column expressions (unit conversion, exact means)
  sources     lake scan / landing, stream source, envelopes, sinks, fixtures
  operators   batch analytics (pure DataFrame -> DataFrame)
  streaming   per-micro-batch analytics, event-time queries, stream runner
  plans       ten-output batch job, SQL temp views, query registry + oracles
  cli         spark-submit entry points (batch, land, stream, monitor)
"""

__version__ = "0.1.0"
