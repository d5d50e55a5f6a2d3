"""termspace: word embeddings and term queries over large text corpora, on Spark.

Every public function takes DataFrames or Columns and gives DataFrames or
Columns back; nothing is collected unless its size is bounded first.
"""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code along, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
