"""quillmark: text corpora, conversations, batch inference and evaluation reports on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel by value, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
