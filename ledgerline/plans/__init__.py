"""Models and jobs a user calls: staging, marts, analytics, ingest, whole pipeline."""
