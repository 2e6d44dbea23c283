"""Inputs, registered queries and their SQL oracles."""
