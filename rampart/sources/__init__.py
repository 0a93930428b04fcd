from rampart.sources.tables import Tables, load_tables  # noqa: F401
