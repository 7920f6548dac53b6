"""PySpark toolkit for mining web crawls: select URLs, read archived pages, detect technologies."""

import sys

from pyspark import cloudpickle

# The functions that run inside Python tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
