"""Scans: response envelopes, page chains, tables."""
