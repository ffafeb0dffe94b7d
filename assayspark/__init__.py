"""Quantitative biomarker assays on Spark: every operator is a DataFrame to DataFrame function."""

import sys

from pyspark import cloudpickle

# Arrow functions travel with their code, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
