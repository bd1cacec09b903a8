"""tonescale: lexicon-based sentiment analysis of document tables on Spark.

Everything is plain DataFrame code.  The sub-packages follow the life of a
corpus: ``sources`` read documents, token records and lexicons, ``functions``
hold column expressions, ``operators`` hold DataFrame transforms, ``sinks``
write results, ``streaming`` applies the stateless transforms to streams and
``plans`` assembles the registered queries.
"""
