"""Dataset builds: one function per output table, no I/O inside."""
