"""Operators over the response table: loading, status rules, parsing, routing, inference, messages."""
