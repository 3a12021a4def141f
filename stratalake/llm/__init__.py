"""Operators that prepare training text: filters, de-duplication, mixing, search and archives."""
