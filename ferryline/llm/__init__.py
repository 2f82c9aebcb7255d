"""Training-data operators: mixing, dedup, formatting, extraction, language
identification, packing and fingerprints, with the queries that apply them.

The functions that run inside Python tasks travel with the job (pickled by
value), so a cluster needs the third-party libraries but no copy of this
package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
