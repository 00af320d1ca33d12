"""DataFrame-in, DataFrame-out operators on device series."""
