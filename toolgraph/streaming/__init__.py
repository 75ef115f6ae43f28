"""Incremental ingestion. An extension: everything else is batch."""
