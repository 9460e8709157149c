"""Training-data operators: language id, decontamination, chat formatting,
SentencePiece pieces, substring and near-duplicate removal, nearest
neighbours, LM and quality scoring, licence scans."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
