"""lavra — medallion ETL for open government data, built on Spark DataFrames.

Layers: ``sources`` (landed files → bronze DataFrames), ``functions``
(Column → Column cleaning, parsing and classification), ``operators``
(DataFrame → DataFrame shaping, dedup, joins, ledger and reports),
``streaming`` (incremental bronze as file streams) and ``plans`` (the
five end-to-end jobs plus the queries registered for the driver).
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# task functions travel by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
