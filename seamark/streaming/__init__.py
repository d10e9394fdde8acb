"""Incremental runs of the batch operators.

The scoring pipelines are batch work; what recurs is loading new series files
and appending new skill rows.  Both reuse the batch parser and the
insert-or-ignore rule under a file-source stream.
"""
