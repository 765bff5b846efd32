"""Data operators: validation, identity, merge, history, star schema, audit."""
