"""conceptloom: concept-graph analytics and corpus preparation on PySpark."""
