"""Column builders: parsing, null rules, ratios and label ladders."""
