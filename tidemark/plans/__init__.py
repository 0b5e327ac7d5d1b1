"""Jobs that sync tables, the stored targets they write, and the registered queries."""
