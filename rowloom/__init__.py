"""rowloom: model-assisted analytics over tables, documents and streams, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
