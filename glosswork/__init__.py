"""Document insight as Spark jobs: ingest, summarize, score, group, index, retrieve.

Every public function takes DataFrames and returns DataFrames.
"""
