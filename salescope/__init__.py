"""Sales analytics as Spark DataFrame operators.

Every public function takes a DataFrame plus plain parameters and returns a
DataFrame built from Spark's own expressions.
"""
