"""Training-data operators: dedup, near-dup joins, PII, mixing, WARC, LM scoring, language ID,
vector joins, toxicity and SentencePiece sampling.

Functions that run in Python workers are shipped by value, so that executors need no copy of this
package. Nothing outside this folder imports it except ``__spark_entry__`` and
``corpus_pipeline`` (which belongs to it).
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
