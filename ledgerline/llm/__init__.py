"""Operators for preparing language-model training data.

Ten operators over tables of documents, pages and vectors, one module each;
``catalog`` registers one query per operator. Nothing else in the library
imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their job, so executors need no installed copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
