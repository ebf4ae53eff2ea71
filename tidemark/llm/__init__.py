"""Training-data operators: filters, deduplication, scoring, sharding, packing.

Nothing else in the package imports this subpackage; ``__spark_entry__.py``
adds its queries when it can be imported.

Functions of this subpackage that run inside tasks are shipped by value, so
executors need numpy, pyarrow and the tokenizer library, but no copy of this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
