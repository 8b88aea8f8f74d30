"""Registered queries: adapters from the given tables to domain tables, operators over them, and SQL forms."""
