"""Manifests, the archival run, the FK graph and the read-only queries."""
