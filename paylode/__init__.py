"""paylode: contract-checked payment data on Spark.

Landing JSON lines become a text copy with lineage (bronze), then typed,
deduplicated and validated tables (silver) with a quarantine for what failed,
then risk features, marts and published (gold) datasets.  Everything is a
DataFrame in, DataFrame out function built from Spark's own expressions.
"""
