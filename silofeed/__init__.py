"""Multi-tenant data ingestion on PySpark."""
