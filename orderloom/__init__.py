"""Order analytics for shops whose carts arrive as JSON documents, as Spark jobs.

Every job is a function ``DataFrame -> DataFrame``.  Orders are kept as one row per
order with the cart as a nested array, so the work that only concerns one order
(line identity, quantities, categories, options) needs no shuffle at all.
"""

__version__ = "0.1.0"
