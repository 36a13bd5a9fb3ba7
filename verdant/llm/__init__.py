"""Training-data operators (quality, chat, search, HTML, BPE, decontamination,
line dedup, WARC archives, language id, near duplicates).

Nothing else in the library imports this package.  Its functions travel to
the executors by value, so workers need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
