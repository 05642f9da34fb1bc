"""Scene analytics on Spark: raw landing, cleaned tables, marts, models and chart datasets."""
