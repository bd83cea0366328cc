"""Cleaning as files arrive."""
