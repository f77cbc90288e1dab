"""Training-data operators.  Nothing outside this package imports it.

Every operator takes a DataFrame and returns a DataFrame; ``queries`` holds
the thin ``opN_*`` queries that ``__spark_entry__`` registers.
"""
