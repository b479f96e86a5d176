"""Document-structuring analytics as DataFrame-to-DataFrame operators on PySpark."""
