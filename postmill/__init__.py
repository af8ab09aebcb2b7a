"""Message-corpus analytics as PySpark DataFrame jobs.

Packages
--------
``sources``    readers: mail folders, lexicons, stop words, key:int lines
``functions``  column expressions: text, dates, headers
``operators``  DataFrame in, DataFrame out: parsing, versions, scoring, terms
``plans``      whole questions: import, reports, keywords
``sinks``      writers: tables, feature columns, tab-separated files
"""
