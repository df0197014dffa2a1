"""Multi-step plans: the incremental load over a versioned store, its lazy
two-run replay on the test data, and mart materialisation."""
