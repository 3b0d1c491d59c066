"""Operators for large-scale training-data preparation.

One module per operator, each with a general interface (any DataFrame with an
id and a text column); ``catalog`` holds the registered queries, ``oracles``
their SQL.  Nothing outside this package imports it.

The functions that run in tasks travel by value, so executors need the listed
public packages but no copy of this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
