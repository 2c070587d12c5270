"""Operators of a training-data pipeline: each module is one operator on DataFrames.

Nothing outside this package imports it. Tables follow the columns of `documents`
(doc_id, text, ...); columns that an operator does not name are left alone or ignored.
"""
