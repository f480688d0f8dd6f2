"""ledgerspark — bookkeeping and bank-statement analytics on Spark.

Layers (all DataFrame-in / DataFrame-out, lazily planned by Catalyst):

* ``sources``   raw statement XML, accounting JSON pages, sheet CSV -> typed rows
* ``functions`` scalar column helpers (amount parsing, keys, dates, sign rules)
* ``plans``     gold reporting views and documented analytical queries
* ``operators`` search / paging / guarded SQL, joins and matching, loaders,
                report operators, batch write-backs
* ``streaming`` raw-to-silver Structured Streaming loads
* ``standins``  adapters mapping the provided TPC-H-like tables onto the silver schema
* ``config``    size-checked, broadcast-marked configuration tables (rules, groups, rates)
* ``queries``   every operator registered over the stand-ins, with its DuckDB oracle SQL
"""

__version__ = "0.1.0"
