"""Fitted calibrators and error rules on streams."""
