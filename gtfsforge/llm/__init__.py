"""Operators for large text corpora (training-data preparation).

Nothing outside this subpackage imports it.  Every module holds one operator
with a general interface plus the thin ``opN_<name>`` query registered in
:mod:`gtfsforge.llm.catalog`.
"""
