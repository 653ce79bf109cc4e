"""Operators of a training-data pipeline over ``documents``.

``queries`` registers one query per operator. Nothing else in the library imports this
subpackage. Functions that run in tasks travel with them, so that executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
