"""Training-data operators: quality, dedup, fingerprints, tokens, mixing.

Nothing else in the package imports this subpackage; its queries are in
``queries.py`` and their DuckDB SQL in ``oracle.py``. Task functions are
pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
