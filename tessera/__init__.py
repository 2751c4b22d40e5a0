"""Spark-native dataset curation: keyed ingestion, deduplication, tag rules, ledgers, reports."""
