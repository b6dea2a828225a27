"""Native column expressions shared by the operators (no Python UDFs)."""
