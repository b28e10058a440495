"""The checked queries: the warehouse fed from the driver's tables.

Not part of the product: adapter of the driver tables to the raw layer, the
scenarios that run the product end to end, and the DuckDB SQL they must match.
"""
