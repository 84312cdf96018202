"""relcast: turn loosely formatted public data releases into typed, dated tables on Spark.

Datasets are declared as data (:class:`relcast.spec.TableSpec`); a small set of
DataFrame operators does the work: release discovery, header normalisation,
tolerant typing, provenance, period replacement / snapshot append, de-duplication,
spelling correction of categories and identifier crosswalks.
"""

__version__ = "0.1.0"
