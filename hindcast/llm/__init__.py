"""Training-data operators: de-duplication, packing, quality, language, media, licences, leaks, toxicity, PII.

Nothing else in the library imports this subpackage.  Importing it pulls in no
operator module, so a Python worker loads only what its task needs.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this subpackage travel to the executors with their code: nothing has to be installed there.
register_pickle_by_value(sys.modules[__name__])
