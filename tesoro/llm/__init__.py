"""Operators for large training corpora (documents, embeddings, labels).

Nothing else in the package imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` binds them to the
driver tables under the names ``opN_<name>``.
"""
