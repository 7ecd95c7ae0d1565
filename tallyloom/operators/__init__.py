"""DataFrame-in, DataFrame-out operators for ``DataFrame.transform``."""
