"""Column helpers: text, paths, URLs, templates, typed reads, skew and lineage."""
