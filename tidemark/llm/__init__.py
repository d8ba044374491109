"""Operators of a large-scale training-data pipeline (deduplication, tokens, quality, archives).

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its queries only
when it can be imported.
"""
