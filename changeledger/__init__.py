"""Change-capture canonicalization and evidence ledger as Spark DataFrame operators."""
