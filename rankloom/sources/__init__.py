"""Readers, writers and the checks that guard them."""
