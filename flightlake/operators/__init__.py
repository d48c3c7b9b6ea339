"""DataFrame -> DataFrame transformations; none of them reads, writes or collects rows."""
