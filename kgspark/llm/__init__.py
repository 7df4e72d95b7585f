"""Training-data operators. Nothing outside this folder imports it; task functions travel with the job."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
