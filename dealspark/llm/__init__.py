"""Training-data pipeline operators: classifiers, quality rules, mixing, HTML
extraction, WARC, sharding, deduplication and packing over documents.

Python functions of this package that run inside tasks are shipped with the
plan (pickled by value), so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
