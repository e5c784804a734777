"""Speech-corpus preparation as Spark jobs: sources, operators, functions, plans and streaming."""
