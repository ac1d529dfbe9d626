"""Registered queries of the core; each takes (spark, sf_dir)."""
