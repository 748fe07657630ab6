"""Operators of a training-data pipeline; nothing else in presslake imports them."""
