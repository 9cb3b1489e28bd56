"""Source configuration and the end-to-end steps built from the operators."""
