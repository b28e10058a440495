"""Operators for preparing large language-model training corpora.

Each module holds one operator with its general interface; ``catalog`` has the
thin ``opN_<name>`` queries and their DuckDB SQL. Nothing outside this
subpackage imports it (``__spark_entry__.py`` adds its queries when present).
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their code, so that executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
