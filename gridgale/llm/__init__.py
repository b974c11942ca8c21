"""Operators for preparing training text."""

from pyspark import cloudpickle

import gridgale

# Functions go to the tasks with their code, so executors need not have the package.
cloudpickle.register_pickle_by_value(gridgale)
