"""Operators of a training-data pipeline: token counts, sharding, benchmark
decontamination, language ID, secret scans, near-dedup, HTML extraction, quality
rules, source mixing and WARC. Nothing outside this folder imports it."""
