"""Registered queries: each a Spark callable over the test tables and, where SQL can say it, the
same question as SQL. The stand-in views bring the test tables into the shapes the operators use."""
