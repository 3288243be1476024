"""Training-data operators: language ID, mixing, chat formatting, packing,
nearest neighbours, LM scoring, quality, fingerprints, near duplicates, toxicity.

Nothing outside this folder imports it. Task functions are pickled by value, so
executors need only the third-party packages, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
