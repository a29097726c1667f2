"""Training-data operators over the text tables.

Nothing else in the library imports this subpackage; ``queries.py`` and ``oracle.py`` here hold the registered
queries and their SQL, and ``__spark_entry__.py`` adds them when the subpackage is present.
"""
