"""Batch table work on Spark: CSV and JDBC in, tallies and keep-latest loads, gated tables out."""
