"""Spark jobs that turn raw retail files into a star schema and query it."""
