"""dyelake: Spark jobs for single-molecule protein sequencing and the data work around it."""
