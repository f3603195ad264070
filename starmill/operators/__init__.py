"""DataFrame-to-DataFrame building blocks: keys, joins, dimensions, fact, sinks."""
