"""Batch and streaming DataFrame operators.

Words against their mean length, grouped and co-grouped records, JSON messages
turned into typed rows, event-time windows, and the panes that triggers cut
windows into.  Everything takes and returns Spark DataFrames.
"""
