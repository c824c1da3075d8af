"""Incremental loading with Structured Streaming.

The source pipeline is a batch truncate-and-reload; its only incremental
semantic is insert-ignore on the warehouse keys.  ``fact_appender`` carries
that semantic to a stream of new order-line fact rows.
"""
