"""lakeloom — a metadata-driven medallion loader written as Spark DataFrame jobs.

Control tables say which source objects are due; set-based jobs load bronze data,
derive silver/gold schemas from a column catalog, upsert silver tables on
business keys with surrogate keys and audit columns, and keep batch ids, run
status, counts and errors for whole fleets of runs at once.

Layout
  sources/    table scans, flat files, JDBC options, schema catalog
  sinks/      versioned snapshot publishing, chunked sorted Parquet
  functions/  column expressions (type defaults, documents, distances, ...)
  operators/  the set-based operators (upsert, control, transitions, ddl, ...)
  plans/      end-to-end load plans (waves, single load, bootstrap)
  streaming/  nothing: the loader is batch only (see its docstring)
"""

__version__ = "0.1.0"
