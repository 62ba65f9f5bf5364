"""logloom: web access-log and order-stream analytics on PySpark.

Layout:

* ``functions``  -- column builders (parsing, IP math, enrichment rules)
* ``sources``    -- text / table / stream readers and the inputs derived
                    from the warehouse tables
* ``operators``  -- DataFrame-level operators (filters, range join, star
                    join, marts, visits, roll-ups, orders, offsets)
* ``plans``      -- composed jobs (ETL stages, writers) and the query
                    catalogue used by the driver
* ``streaming``  -- Structured Streaming queries (unpaid-order reminder,
                    offset history)
"""

from logloom.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
