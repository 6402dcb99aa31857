"""Programs for ``spark-submit``: the refresh of a change log, the load of pages."""
