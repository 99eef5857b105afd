"""Writers: replace, append-new, upsert, selection document, result files."""
