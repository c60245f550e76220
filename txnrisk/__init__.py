"""Batch review of payment transactions on Spark.

Transactions are ingested, cleaned, enriched, checked, used to train a
forest, scored, and the risky ones are queued for review. Every step is a
function from DataFrame to DataFrame; ``txnrisk.plans`` strings them together.
"""
