"""Content-risk analytics as Spark plans."""

import sys

from pyspark import cloudpickle

from riskloom.model import DEFAULT_MODEL, RiskModel

# Functions sent to executors travel whole: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DEFAULT_MODEL", "RiskModel"]
