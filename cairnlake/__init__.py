"""cairnlake: a layered lake of public activity events, built as Spark jobs.

Raw hourly JSON files -> bronze (flat, everything kept) -> silver (clean,
deduplicated, typed) + quarantine (rejected rows with a reason) -> gold (daily
repository and contributor aggregates), with versions, checks and reports.
"""

__version__ = "0.1.0"
