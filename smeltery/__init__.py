"""smeltery: bronze, silver and gold tables refined with plain PySpark.

The package is shipped to Python workers by value, so a cluster needs no
installed copy of it for its Arrow functions and its paged source.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
