"""DataFrame → DataFrame operators, grouped by warehouse layer."""
