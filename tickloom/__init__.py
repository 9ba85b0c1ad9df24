"""Price-series analytics as Spark DataFrame functions.

``functions``  column expressions (dates, numbers, names, scores)
``sources``    readers and writers for price files and curated tables
``operators``  DataFrame -> DataFrame transformations, keyed by ``symbol``
``plans``      whole jobs: curate, treat, forecast, compare models, explore
``workload``   the registered queries over the given tables
"""
