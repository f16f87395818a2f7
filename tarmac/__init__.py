"""tarmac — airline on-time analytics on Spark.

Eight fixed questions over a flight table (airport popularity, mean
arrival / departure delays by carrier, weekday, origin and route,
top-ten rankings, best two-leg trips), answered as batch DataFrame plans
and as Structured Streaming queries whose final tables agree.
"""

from tarmac.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]

import sys

from pyspark import cloudpickle

# Functions that Spark runs in Python workers travel with the job, so that
# executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
