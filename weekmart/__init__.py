"""weekmart: weekly sell-out / sell-in analytics as Spark DataFrame plans.

Every public function takes and returns DataFrames (or Columns), keeps no state, reads no clock
and never brings rows to the driver. Sub-packages:

* ``functions``  column expressions: cleaning and dates
* ``operators``  DataFrame operators: calendar, series, mapping, history, metrics, quality
* ``plans``      compositions: analysis, sell-in, conform, marts
* ``sources``    readers, schemas, sinks and load modes
* ``streaming``  incremental loads with Structured Streaming
* ``catalog``    the registered queries and their SQL counterparts
"""

__version__ = "0.1.0"
