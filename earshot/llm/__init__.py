"""Operators for training-data pipelines over text, one module each; nothing else imports them."""
