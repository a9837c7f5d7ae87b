"""The library's operators run on the star-schema tables, each beside its SQL."""
