"""Registered queries over the check tables (``queries``) and their SQL oracles (``oracles``)."""
