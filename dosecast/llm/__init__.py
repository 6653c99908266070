"""Training-data pipeline operators.

Nothing else in the library imports this subpackage; its queries are in
``llm.queries`` and are registered by ``__spark_entry__`` when it is present.
"""
