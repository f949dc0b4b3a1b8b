"""Registered queries and their SQL oracle text."""
