"""Training-data operators: archives, decontamination, packing, scoring, near
duplicates, classifiers, chat rendering, extraction and exact search.

Each module holds one operator; ``queries`` registers one query per operator.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# functions of these modules travel to the executors by value: nothing has to be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
