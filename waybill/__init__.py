"""Delivery-risk analytics for marketplace orders, written as Spark DataFrame functions.

Layout
------
``sources``    readers, snapshot views and sinks
``functions``  column expressions (dates, distances, text, labels)
``operators``  reusable DataFrame -> DataFrame building blocks
``plans``      the domain layers: staging, order grain, star schema, features,
               model, scores, review themes, dashboard reports, profiles
``catalog``    every registered query next to the SQL that checks it
"""
