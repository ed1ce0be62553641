"""Operators for preparing training data; nothing else in the package imports them.

Task functions of this subpackage travel to the workers by value, so a cluster
needs the repository on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
