"""Training-data operators: ten corpus operators and the tables they read.

Nothing else in the library imports this subpackage; ``queries`` holds its
driver queries and ``corpus_pipeline.py`` (repository top) chains five of them.
"""
