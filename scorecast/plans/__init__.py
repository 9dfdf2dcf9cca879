"""Report plans: usage (weekly usage), extracts (benchmark / state-test
extracts), status (benchmark completion)."""
