"""Operations of a training-data pipeline over documents, vectors and web pages.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job; executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
