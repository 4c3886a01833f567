"""Compositions that hold state or write: loads, snapshots, medallion flows, query registry."""
