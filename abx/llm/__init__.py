"""Operators for preparing training text at scale; see the README's section on them.

Nothing else in the library imports this subpackage. Its functions are shipped
to Python workers by value, so executors need numpy, pyarrow and the tokenizer
libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
