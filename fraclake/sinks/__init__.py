"""Writers: hash sets, archives and vectors, tables with metadata, reports."""
