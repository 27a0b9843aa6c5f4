"""Training-data operators on Spark: filters, near-duplicate search, resolution and mixing.

Each module holds one operator with its general interface; ``queries`` holds
the registered ``opN_<name>`` queries over the given tables. Nothing outside
this subpackage imports it.
"""
