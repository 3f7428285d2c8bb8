"""ratewise: profiling, auditing, preparation and classification of flat tables on Spark."""

import sys

from pyspark import cloudpickle

# The few grouped-map functions travel inside the job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
