"""Writers: landing, processed files, append load, dedup rewrite."""
