"""Multi-job plans: order statistics, quotas, the version store, rounds."""
