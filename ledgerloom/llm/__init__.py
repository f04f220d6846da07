"""Operators of a training-data pipeline: documents, embeddings, conversations.

Nothing else in the library imports this subpackage.  Its functions run inside
Python workers, so the package is pickled by value: an executor needs numpy,
pyarrow and the tokenizer files, not a copy of this repository.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
