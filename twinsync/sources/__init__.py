"""Reading landed records and keeping tables."""
