"""Training-data operators: search, packing, filtering, de-duplication, tokens.

Every module works on a table with ``doc_id`` and ``text`` (vectors for
:mod:`topk`). Nothing outside this subpackage imports it.
"""
