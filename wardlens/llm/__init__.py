"""Operators of a text-corpus pipeline; nothing else in the library imports them."""
