"""Job-posting analytics on Spark: ingest, normalise, model, report, retrieve."""
