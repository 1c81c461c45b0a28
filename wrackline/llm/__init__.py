"""Operators for training-data problems on text; nothing else imports them."""
