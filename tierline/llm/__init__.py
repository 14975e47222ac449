"""Operators for preparing training text; nothing else in tierline imports them."""
