"""Event tracking over article feeds on Spark: sources, extraction, matching, clustering, review state and feeds."""
