"""Inputs and outputs: input tables, versioned main / archive folders, audit
tables, catalogue listings."""
