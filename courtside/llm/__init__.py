"""Operators for preparing training text and vectors. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions of these modules travel to the executors with their code, so no executor needs the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
