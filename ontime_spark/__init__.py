"""On-time-performance analytics as Spark jobs: batch, streaming and a delay model."""
