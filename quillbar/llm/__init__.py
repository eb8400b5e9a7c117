"""Operators for preparing training text: scoring, deduplication, decontamination, labelling, redaction and mixing.

Functions that run in tasks travel with the job, so workers need no copy of this folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
