"""Training-data operators: licences, decontamination, tokens, fingerprints, secrets, duplicates,
chat windows, language and toxicity.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
