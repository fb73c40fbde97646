"""Readers: text, JSON and XML into DataFrames, bad rows kept aside with a reason."""
