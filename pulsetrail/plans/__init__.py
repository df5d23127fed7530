"""Complete jobs: scan, clean, sample, train, evaluate, score, write."""
