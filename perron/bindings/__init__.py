"""The engine on the check tables: raw-layer frames made from them, queries, and SQL to compare with."""
