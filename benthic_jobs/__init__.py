"""Spark jobs. Tasks are what runs side by side, so numpy's linear algebra keeps to one thread unless the caller says otherwise."""

import os

os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")
