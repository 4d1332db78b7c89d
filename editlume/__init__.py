"""editlume: wiki-activity analytics and data preparation on PySpark."""
