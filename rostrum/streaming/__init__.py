"""Streams.  The operations of the library that need no global order run on streaming DataFrames as they are:
scans, predicates, projections, labels, ``operators.speakers.with_day``.  ``writes`` keeps state."""
