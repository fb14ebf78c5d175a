"""ledgerline: Spark-native complaint analytics and decisioning.

Every operator takes and returns DataFrames; nothing is collected inside an
operator.  See README.md for the module map.
"""

from ledgerline.params import Params

__all__ = ["Params"]
