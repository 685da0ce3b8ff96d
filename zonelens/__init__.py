"""zonelens: reusable PySpark operators for sensor readings and document collections.

Every public operator takes Spark DataFrames and returns Spark DataFrames; the
work is declared with the DataFrame / SQL API so Catalyst plans it.  Sub-packages:

* ``sources``   – scans, sinks and adapters from raw tables to canonical shapes
* ``functions`` – column-expression builders (calendar, text, hashing, ratios)
* ``operators`` – table-in / table-out operators (cleaning, profiles, windows,
  statistics, models, text, neighbours)
* ``plans``     – end-to-end analyses composed from operators, and the query registry
"""

__version__ = "0.1.0"
