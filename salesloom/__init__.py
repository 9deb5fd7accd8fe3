"""Sales warehouse jobs on Spark: sources, layers, marts, checks, reports and sinks."""
