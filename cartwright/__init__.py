"""cartwright: a retail analytics warehouse written as Spark jobs.

Layers (one Spark database each): raw -> staging -> intermediate -> marts.
Model functions take DataFrames and return DataFrames without doing I/O, so the
same code serves pipelines, tests, the DuckDB oracle checks and the benchmark.
"""

__all__ = ["session", "contracts", "fixed"]
