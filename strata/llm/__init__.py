"""Operators for training-data pipelines: dedup, quality, licences, decontamination, tokens, archives, URLs.

Nothing outside this package imports it; ``corpus_pipeline.py`` and
``queries.py`` here put the operators to work.
"""

import sys

from pyspark import cloudpickle

# functions sent to the executors carry their code: no copy of the package is needed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
