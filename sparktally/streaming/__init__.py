"""The count questions over a growing folder of review files.

The jobs being rebuilt are batch jobs; nothing in them is a stream. Their
counting questions (reviews per category or aspect) are nevertheless also
meaningful over a folder that keeps receiving review files: a Structured
Streaming query ingests the valid rows of new files incrementally and
exactly once, and the same ``count_by`` operator counts what has been
ingested. No new operator is involved.
"""

from sparktally.streaming.counts import ingested_counts, review_stream, start_review_ingest

__all__ = ["ingested_counts", "review_stream", "start_review_ingest"]
