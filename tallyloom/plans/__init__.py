"""The registered queries: each a plan over the tables and the SQL it must equal."""
