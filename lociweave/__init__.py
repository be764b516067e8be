"""Interval and haplotype analytics over assembled genomes, expressed as Spark jobs."""

import sys

from pyspark import cloudpickle

from .config import AlleleRules, CallRules, FeatureRules, HitRules, LocusRules
from .session import get_spark, materialize

# Functions that run inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "AlleleRules",
    "CallRules",
    "FeatureRules",
    "HitRules",
    "LocusRules",
    "get_spark",
    "materialize",
]
