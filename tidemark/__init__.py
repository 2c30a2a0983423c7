"""Dated web snapshots to audited history tables, as Spark DataFrame jobs."""
