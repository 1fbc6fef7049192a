"""shelfline: retail decision-support analytics as plain PySpark jobs.

Layout
------
sources/    readers and writers (driver tables, delimited text, CSV, run logs)
plans/      the star-schema build (dimensions, facts, pricing, returns,
            inventory) and the decision-support query catalogue
operators/  the relational building blocks the catalogue is made of
            (joins, aggregates, windows, set operations, quality checks)
functions/  scalar helpers that stay inside Catalyst (no Python UDFs)
streaming/  incremental refresh applied batch by batch (usable from
            ``foreachBatch``)
"""

from shelfline.session import get_session, scratch_dir  # noqa: F401
