"""The marts: music star schema, query tables, immigration schema."""
