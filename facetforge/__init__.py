"""Classification of categorical tables and vector documents, as Spark jobs."""

import sys

from pyspark import cloudpickle

from facetforge.config import BoostSettings, ClassificationTask, DeliveryPolicy

__all__ = ["BoostSettings", "ClassificationTask", "DeliveryPolicy"]

# Functions that run inside tasks travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
