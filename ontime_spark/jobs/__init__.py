"""Command lines for ``spark-submit``, one per job."""
