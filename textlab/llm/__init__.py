"""Operators of a training-data pipeline: tokens, urls, licences, dedup, WARC."""
