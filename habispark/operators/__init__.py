"""DataFrame-to-DataFrame operators. Only the size check of `skew` runs a job while planning."""
