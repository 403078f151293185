"""Spark-first analytics jobs: table preparation, text statistics, page extraction,
located messages and MLlib pipelines."""
