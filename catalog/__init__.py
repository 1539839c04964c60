"""Registered queries, their SQL counterparts, and the source tables both are run on."""
