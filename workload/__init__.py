"""The engine's queries bound to the test tables, each with an SQL counterpart."""
