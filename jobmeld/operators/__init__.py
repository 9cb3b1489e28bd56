"""DataFrame operators: de-duplication, matching, merging, extraction, enrichment."""
