"""Registered queries by subject; importing a module registers its queries."""
