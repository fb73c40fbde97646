"""Operators of a training-data pipeline: identify, score, filter, de-duplicate, shard, encode."""
