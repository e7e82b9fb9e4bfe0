"""DataFrame-in, DataFrame-out operators of the topic job."""
