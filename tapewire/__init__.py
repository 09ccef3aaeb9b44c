"""tapewire: Spark DataFrame operators for news text and market bars."""

import sys

from pyspark import cloudpickle

# Functions handed to executors travel with the job, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
