"""Operators for preparing language-model training data.

Columns an operator adds replace input columns of the same name. Names that begin with an underscore
are the operators' own: input columns so named may be missing from a result.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
