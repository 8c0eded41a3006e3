"""threadweave: discussion-graph analytics on Spark DataFrames.

Posts and comments are cleaned, turned into a user->user comment graph and a
user/subreddit property graph, and analysed with DataFrame-native graph
operators (PageRank, strongly connected components, triangle counts, a
collaboration motif) plus pair/posting counts and named reports.

Layout:
  functions/  column expressions (Java string hash, cleaning predicates)
  sources/    table readers, the fixture views over the test tables, sinks
  operators/  prep, graph building, counts and the graph algorithms
  plans/      reports, the query catalog and its DuckDB oracle SQL
  streaming/  incremental (file-stream) ingestion of the prep stage
"""

from threadweave.operators.graph import PropertyGraph  # noqa: F401

__all__ = ["PropertyGraph"]
