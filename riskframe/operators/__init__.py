"""DataFrame operators: every public function takes and returns Spark DataFrames."""
