"""Jobs that prepare text corpora for training, as Spark jobs.

Each module holds one operator with an interface of its own; ``queries`` applies
them to the given tables. Nothing outside this folder imports it.
"""
