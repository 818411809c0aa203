"""Registered queries, their SQL counterparts and the views they share."""
