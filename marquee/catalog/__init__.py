"""Registered queries, their stand-in tables and their SQL counterparts."""
