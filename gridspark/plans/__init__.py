"""Registered queries: input mapping, Spark plans and their SQL oracles."""
