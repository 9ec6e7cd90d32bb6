"""A Spark-native payment reconciliation and settlement analytics engine."""
