"""The registered queries and their SQL oracles, grouped by topic."""
