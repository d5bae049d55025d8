"""Operators of the session job. Each is a function DataFrame(s), parameters -> DataFrame."""
