"""Page, link, record and keyed-entity tables as Spark jobs.

``functions``  Column expressions (text, links, markup, embedded state)
``operators``  DataFrame-in, DataFrame-out jobs built from them
``sources``    table, page, response and robots inputs, and the sinks
``streaming``  the harvest, upsert and summary jobs over streams
``plans``      the named queries with their DuckDB counterparts
"""

import sys

from pyspark import cloudpickle

# Python workers need not have the package: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
