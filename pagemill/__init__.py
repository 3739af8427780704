"""pagemill: web-page cleaning and event-relevance ranking as Spark jobs."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Ship the helpers that run inside Python workers with the job itself.
register_pickle_by_value(sys.modules[__name__])
