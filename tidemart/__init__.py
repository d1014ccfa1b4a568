"""tidemart: commerce warehouse models (ingest, latest-version dedupe, staging,
dimensions, facts, KPI marts, data-quality checks) expressed as Spark
DataFrame operators."""

__version__ = "0.1.0"
