"""Sources: driver tables and their adapters, text streams, JDBC, files."""
