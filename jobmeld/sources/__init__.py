"""Readers, writers, snapshot tables and schema alignment."""
