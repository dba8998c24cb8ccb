"""embedlift: moving, reshaping and verifying collections of vectors with Spark."""

import sys

from pyspark import cloudpickle

# Arrow functions of this package run inside Python workers. Shipping them by
# value keeps a job working when the package is only installed on the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
