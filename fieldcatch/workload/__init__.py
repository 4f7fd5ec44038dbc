"""The registered queries: each library operator over the generated tables, with its SQL twin."""
