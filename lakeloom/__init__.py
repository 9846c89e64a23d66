"""lakeloom: metadata-driven layered lakehouse loads on Spark DataFrames.

A table is described by a :class:`~lakeloom.spec.TableSpec`; the loads in
:mod:`lakeloom.plans.loads` turn a spec into one Spark plan (scan, schema
projection, ordered column transforms, latest-row-per-key, enrichment join) and a
sink (versioned overwrite or timestamp-guarded upsert).
"""

from lakeloom.spec import LookupSpec, TableSpec

__all__ = ["LookupSpec", "TableSpec"]
__version__ = "0.1.0"
