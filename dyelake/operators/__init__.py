"""operators of dyelake."""
