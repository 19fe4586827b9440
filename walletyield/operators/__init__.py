"""DataFrame -> DataFrame operators.

* ``scan``     skew-safe running aggregates per key (``keyed_scan``)
* ``ledger``   CDC parsing, running balances, snapshots, validity, monotonic times
* ``rates``    daily rates, validation, range, as-of lookup, upsert, loading
* ``asof``     by-key backward as-of join
* ``quality``  duplicates, keys, NULLs, orphans, rule check, constraint report
* ``metrics``  daily totals, distinct users, trailing averages, top-k days
* ``logs``     log parsing, filters, counts, timeline, step timings
* ``sinks``    publish by day, upsert, insert-if-absent, surrogate keys, writers
* ``common``   attaching one-row scalars
"""
