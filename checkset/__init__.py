"""Queries over the driver's test tables, with equivalent SQL, for checks and benchmarks."""
