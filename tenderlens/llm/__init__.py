"""Operators for preparing training data for language models; nothing else imports them."""
