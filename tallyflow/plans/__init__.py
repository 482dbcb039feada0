"""End-to-end plans, the query registry and its SQL oracle."""
