"""Inputs: Bronze CSV ingest (``csv``), landing zone scans (``landing``),
clinical fixture views over the benchmark tables (``fixtures``) and the
synthetic generator (``synthetic``)."""
