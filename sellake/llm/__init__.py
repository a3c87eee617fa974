"""Training-data operators (ten dealt operators), their registered queries and SQL. Nothing outside imports this package."""
