"""Retail analytics views expressed as Spark DataFrame plans.

Layout:
  sources/    readers for order/customer exports and wide text reports, sinks,
              and the adapters that shape /root/testdata into those inputs
  functions/  column expressions (calendar, text)
  operators/  reusable relational building blocks (pair counting, indicator
              counts, gaps, growth, reshaping, histograms)
  plans/      the user-facing views, one pure function per view
"""

__version__ = "0.1.0"
