"""Operators for preparing training corpora, and their registered queries.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries when the folder is present.
"""
