"""Readers: catalog and path tables, JSON documents, JDBC snapshots."""
