"""Input tables, queries and their SQL counterparts, used by the tests, the bench and the driver."""
