"""camstat: camera-trap survey analytics as Spark DataFrame operators.

Every public operator is a plain ``DataFrame -> DataFrame`` function built on
Spark SQL expressions, joins, aggregations, windows and MLlib.  Sub-packages:

* ``sources``   -- readers, sinks and the driver-table adapters
* ``functions`` -- scalar column expressions (ids, paths, time, boxes, geo)
* ``operators`` -- filters, joins, aggregates, windows, reshapes, reconcile,
                   spatial joins, repeat suppression, images, learning
* ``plans``     -- named end-to-end queries over the driver tables
* ``streaming`` -- Structured Streaming ingest and visit sessions
"""

__version__ = "0.1.0"
