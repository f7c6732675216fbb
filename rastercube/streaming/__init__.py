"""Nothing here: the operators this engine covers have no streaming form, and none is made up.

New months are a batch: sources.catalog finds them, sources.sinks.cube adds their partitions.
"""
