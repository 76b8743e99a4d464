"""leakscope: pipeline sensor-risk analytics expressed as Spark DataFrame, SQL,
MLlib and Structured Streaming jobs.

Layers: ``sources`` (message/table readers and writers), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (the
medallion job order and the registered queries), ``streaming`` (stream starters).
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions shipped to Python workers (tree fitting, scoring, the stateful
# step) are pickled by value, so executors need no installed copy of this
# package and jobs do not depend on the driver's working directory.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
