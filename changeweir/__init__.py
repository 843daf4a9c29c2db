"""Change-data-capture analytics on PySpark.

Snapshots and change logs come in (``sources``), are decoded and typed
(``functions``, ``operators``), land by primary key in versioned lake tables
(``operators.lake``), keep a layered set of models current (``plans``,
``streaming``) and are checked (``operators.quality``).
"""

__version__ = "0.1.0"
