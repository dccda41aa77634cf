"""DataFrame to DataFrame steps, each safe under a key that holds much of the data."""
