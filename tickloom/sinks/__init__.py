"""Writers: tables, text, partitioned exports and their checks."""
