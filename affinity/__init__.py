"""affinity: grade mining and basket affinity on Spark DataFrames.

Every operator takes and returns a ``pyspark.sql.DataFrame``; column names are
arguments with the (user, item, value) defaults ``sno``, ``cno``, ``score``.

Sub-packages
------------
``sources``    readers for score tables, basket files, wide score sheets, JDBC
``sinks``      writers for predictions, rules, itemsets, labels, text files
``functions``  column-expression helpers shared by the operators
``operators``  prep, similarity, recommend, baskets, profile, clustering, anonymize
``plans``      end-to-end jobs (train / predict / mine) and the query catalogue
``streaming``  micro-batch scoring of arriving score rows
"""

from affinity.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
