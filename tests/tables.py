"""Where the given tables for tests are."""

TABLES = "/root/testdata/sf0.001"
