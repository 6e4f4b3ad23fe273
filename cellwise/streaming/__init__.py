"""No streaming operators.

The table format this library models is written in batches (day or hour
cadence) and read from frozen snapshots; it has no watermark, window, state
or late-data code path.  Late data is handled in batch by the version rule:
a cell written with an older timestamp loses to the stored one
(``operators.upsert.upsert_cells``).  A Structured Streaming job can still
feed a table by calling ``CellStore.write`` from ``foreachBatch``; nothing
in this package is needed for that.
"""
