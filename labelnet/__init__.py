"""labelnet: turn a corpus of labelled documents into a graph of labels.

Every operator takes and returns Spark DataFrames; the driver only holds
parameters, iteration counters and a handful of scalars.

- ``sources``    readers / writers and the mapping of the shared tables
- ``functions``  text cleaning as Column expressions; the Porter stemmer helper
- ``operators``  relational layer, features, similarity, graph, Louvain, co-occurrence
- ``plans``      end-to-end flows, the named query registry and its oracle SQL
- ``streaming``  incremental forms of usage counts and post tagging
"""

__version__ = "0.1.0"
