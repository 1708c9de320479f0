"""Spark operators that turn raw record tables into typed tables, star schemas and feature tables."""
