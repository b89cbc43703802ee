"""Queries of the driver contract with their SQL counterparts, by area."""
