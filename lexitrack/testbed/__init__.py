"""The given star-schema tables as study tables, and the queries as SQL over them."""
