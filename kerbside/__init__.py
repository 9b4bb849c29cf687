"""kerbside: trip analytics on Spark DataFrames.

Every public operator takes DataFrames and returns DataFrames; nothing runs
until the caller asks for rows, apart from the publishing functions in
``kerbside.plans`` which must see a count before they choose what to write.
"""
