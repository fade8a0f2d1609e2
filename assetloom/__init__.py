"""Media-asset ledger analytics on Spark.

``functions``  column -> column expressions (names, urls, times, sizes, JSON)
``operators``  DataFrame -> DataFrame building blocks (filters, joins, ledgers,
               metrics, numbering, set logic)
``plans``      whole jobs: segment plans, manifests, renames, log reports
``sources``    readers and sinks
``streaming``  Structured Streaming forms
``registry``   the named queries and the SQL they are checked against
"""
