"""Statement analytics on Spark: change logs in, indicators and summaries out.

Everything is a DataFrame-to-DataFrame function; nothing runs until a sink or an
action asks for it.  Import from the sub-packages:

* ``tallyline.sources``    change logs, stored state, pages, CSV statements
* ``tallyline.operators``  decode, compact, merge, indicators, summaries, extraction
* ``tallyline.functions``  the scalar expressions the operators are made of
* ``tallyline.sinks``      CSV / parquet / catalog tables, versioned snapshot, JDBC
* ``tallyline.streaming``  the continuous form of decode, compact and merge
* ``tallyline.plans``      the end-to-end refreshes and the registered queries
"""
