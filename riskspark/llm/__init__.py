"""Training-data operators: filtering, deduplication, mixing and tokenisation of documents.

Nothing else in the package imports this subpackage. Operators keep their own general
interface; the registered queries (``queries.py``) and the corpus pipeline wrap them.
"""
