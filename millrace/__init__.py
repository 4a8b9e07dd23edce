"""Millrace: warehouse and lake data work as plain Spark functions.

Every public function takes a SparkSession or a DataFrame and returns a
DataFrame (or a Column), so whatever is built from them is one Catalyst plan.
"""
