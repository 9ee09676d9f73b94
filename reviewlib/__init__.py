"""Customer-review text analytics on Spark.

``functions``  column expressions (cleaning, ratings, dump fragments)
``sources``    readers and writers
``operators``  DataFrame -> DataFrame transforms and reports
``plans``      jobs, and the queries registered for checking
``streaming``  the row-local jobs over file streams
"""
