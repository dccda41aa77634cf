"""Review analytics expressed as Spark DataFrame jobs.

``functions`` holds column expressions, ``operators`` holds DataFrame to DataFrame
steps, ``sources`` reads and writes, ``plans`` composes them into the cleaning job,
the analyses, the chart feeds and the helpfulness model, and ``catalog`` binds all of
them to the test tables together with an equivalent SQL statement.
"""
