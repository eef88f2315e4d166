"""Typed, audited tables from raw, dirty ones: cleaning, quality reports and loads on Spark."""
