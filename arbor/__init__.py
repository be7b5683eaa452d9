"""arbor: merger-forest analytics as Spark jobs.

``sources`` read and write tables, ``functions`` are column expressions, ``operators`` are
DataFrame-to-DataFrame jobs, ``plans`` hold the means to run them (sessions, cut lineage,
query registry), ``streaming`` has the incremental forms and ``llm`` the operators for
training data, which nothing else here imports.
"""

__version__ = "0.1.0"
