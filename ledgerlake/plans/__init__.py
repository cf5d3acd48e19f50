"""Session settings, the end-to-end flow and the registered queries."""
