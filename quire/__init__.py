"""Document analytics on Spark: item tables, bounded queries, catalog and upload operators."""
