"""Named queries over star-schema tables and the SQL they are checked with."""
