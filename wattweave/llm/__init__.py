"""Operators for preparing training text: each works on a DataFrame with an id and a text column."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with their code, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
