"""Reading dumps and registries, writing and reading tables."""
