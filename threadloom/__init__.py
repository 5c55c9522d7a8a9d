"""threadloom: building, maintaining and searching a corpus of threaded
discussions with PySpark DataFrames."""

import sys

from pyspark import cloudpickle

from threadloom.session import configure, local_session, materialize, shared_dir

# Functions that run in tasks travel with the plan, so executors need not have
# the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure", "local_session", "materialize", "shared_dir"]
