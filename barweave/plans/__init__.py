"""End-to-end programs and the registered queries."""
