"""Sinks: snapshot envelopes and table writes."""
