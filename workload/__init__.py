"""The queries of the correctness check and the benchmark, each with the SQL that gives the same result."""
