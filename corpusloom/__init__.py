"""Versioned, searchable text corpora on Spark.

Task functions of this package are shipped to executors by value, so a cluster needs
only numpy and pyarrow on its workers, not an installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
