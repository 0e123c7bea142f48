"""Operators for preparing training text, apart from the record sync: nothing else imports them."""
