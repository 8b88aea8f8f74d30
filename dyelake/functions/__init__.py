"""functions of dyelake."""
