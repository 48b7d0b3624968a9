"""panelspark: holdings baskets, factor panels, asset-token corpora and
embeddings as Spark DataFrame plans.

Subpackages: ``functions`` (column expressions), ``operators`` (DataFrame
operators), ``sources`` (readers and writers), ``plans`` (pipelines and the
registered queries), ``streaming`` (incremental ingest and reports).
Library functions never create a session; use ``session.local_session``
for local work and tests.
"""

__version__ = "0.1.0"
